"""A small folder of tables with nulls, empty and very long texts, ties, repeats and clashing columns."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
from rowsmith.llm.license_templates import TEMPLATES

SYLLABLES = "ba be bo ka ke ko li lo lu ma mi mo na ne ra ri so ta te to".split()
#: Columns of the operators' results, and names used inside: none may clash with a column of the input.
EXTRA = (
    "size", "taken", "target", "copy", "score", "kept", "fp", "key", "n", "shingles", "place", "component", "__score", "row",
    "y", "id", "of", "turn", "mask", "same", "part", "file", "at", "lang_pred", "copy_words", "source_size",
    "__n", "__t", "__c", "__key", "__row", "__lines", "__before", "__size", "__turn", "__copy", "__salt", "__hot", "__taken", "__target",
)


def word(r):
    return "".join(r.choice(SYLLABLES) for _ in range(r.randint(2, 4)))


def prose(r, n, per_line=14):
    words = [word(r) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + per_line]) + "." for i in range(0, n, per_line))


def texts(seed=7):
    """(name of a group, text) per document."""
    r = random.Random(seed)
    found = [("clean", prose(r, r.randint(60, 160))) for _ in range(60)]
    base = prose(r, 300)
    found += [("copy", base)] * 4
    for i in range(4):
        words = base.split(" ")
        words[10 + 40 * i] = "changed"
        found.append(("near", " ".join(words)))
    found += [("toxic", prose(r, 90).replace(" ", " idiot ", 2).replace(".", " scum.", 1)) for _ in range(30)]
    found += [("junk", " ".join(f"{word(r)}### | {word(r).upper()}!!" for _ in range(60))) for _ in range(30)]
    found += [("license", prose(r, 70) + "\n" + t) for t in TEMPLATES.values()]
    shared = prose(r, 56, 60)
    found += [("shared", prose(r, 80) + "\n" + shared) for _ in range(6)]
    found += [("boiler", prose(r, 80) + "\nall 12 rights are reserved by the host of it") for _ in range(30)]
    found += [("empty", ""), ("empty", " \n\t "), ("empty", None), ("short", "ein zwei"), ("odd", "a\u0085b c\u2028d \x1c e")]
    found += [("long", prose(r, 20_000)), ("repeat", "so it goes " * 60), ("leak", prose(r, 90))]
    return found


def benchmark(leaky):
    r = random.Random(11)
    words = leaky.split()
    return [
        (0, prose(r, 30)), (1, " ".join(words[20:50]).upper()), (2, ""), (3, None), (None, prose(r, 20)), (4, "ein zwei"),
        (5, " ".join(words[60:63])), (6, words[7]), (7, " ".join(words[30:34])),
    ]


def write(folder, rows, schema):
    columns = list(zip(*rows)) or [[] for _ in schema]
    arrays = [pa.array(c, k) for c, (_, k) in zip(columns, schema)]
    pq.write_table(pa.Table.from_arrays(arrays, names=[n for n, _ in schema]), folder)


DOCUMENTS = [
    ("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()),
    *[(name, pa.string()) for name in EXTRA],
]
LABELS = [("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32()), ("score", pa.string())]
PAGES = [("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()), ("verdict", pa.string())]
ITEMS = [("item_id", pa.int64()), ("text", pa.string()), ("shingles", pa.string())]
TURNS = [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("n_turns", pa.string())]

PAGE_ROWS = [
    (0, "http://a.net/x", '<link rel="canonical" href="http://example.org/es/1">', None),
    (1, "http://example.org/es/1", "", None),
    (2, "https://b.net/y?q=1#f", '<META http-equiv="Refresh" content="0; url=HTTP://A.net/x">', None),
    (3, "http://c.net/z", "<link href='http://w.org/ok' rel='canonical'><link rel=canonical href=http://example.org/es/2>", None),
    (4, "http://example.org/en/12", "", None), (5, "http://example.org/en/2", "", None), (6, "http://M.Example.COM/de/3", None, None),
    (7, "http://x.com/fr/3", "<link rel='canonical' href='/relative'>", None), (8, "http://notorg/x", "", None),
    (9, None, "<link rel='canonical' href='http://a.net/x'>", None), (10, "nothing", "", None), (11, "", None, None),
    (None, "http://a.net/x", "", None), (0, "http://a.net/x", "", None), (12, "http://b.net/y?q=1", "", None),
    (13, "http://b.net/y?q=2", "", None), (14, "http://d.net?a=1", "", None), (15, "x://org", "", None), (16, "http://org/", "", None),
    (17, "http://shop.com/xx/9", "<meta http-equiv=refresh content='0;url=/de/9'>", None),
    (18, "http://r.net/y", "<link rel=canonical href='//shop.com/xx/9'>", None),
    (19, "http://r.net/a/z", "<link rel=canonical href=../y>", None), (20, "http://r.net", "<link rel=canonical href=y>", None),
    (21, "http://r.net/q", "<link rel=canonical href='#y'>", None), (22, "http://r.net/b/c?x", "<link rel=canonical href='./../a/./z'>", None),
    (23, "http://r.net/b/d/", "<link rel=canonical href='..'>", None), (24, "http://r.net/b/", "<link rel=canonical href='?de'>", None),
    (25, "http://r.net/b/?de", "<link rel=canonical href='../../../a/z?'>", None), (26, "http://r.net/m", "<link rel=canonical href='mailto:a@b.c'>", None),
    (27, "nowhere", "<link rel=canonical href='/y'>", None), (28, "http://r.net/a/z?", "<link rel=canonical href=/de/&amp;x>", None),
    (29, "http://r.net/de/&x", "<link rel=canonical href='https://u.com/de/'>", None),
]
VECTORS = [("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("cluster", pa.string()), ("distance", pa.string())]


def vectors():
    r = random.Random(5)
    middles = [[r.gauss(0, 0.4) for _ in range(64)] for _ in range(20)]
    rows = [(i, [m + r.gauss(0, 0.15) for m in r.choice(middles)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(50)] + [rows[3], rows[3], (None, rows[4][1]), (None, [0.0] * 64)]
    rows += [(400, None), (401, []), (402, [1.0] * 63), (403, [1.0] * 65), (404, [None] + [0.0] * 63), (405, [float("nan")] * 64)]
    rows += [(406, [float("inf")] + [0.0] * 63), (407, [float("-inf")] * 64), (408, [-0.0] * 64), (409, [1e4] * 64)]
    return [(i, v, "clash", "clash") for i, v in rows]


TURN_ROWS = [
    (1, 0, "user", "Hi <|end|>\\", None), (1, 1, "assistant", "  café \\n <|turn|> ", None), (1, 2, "assistant", "", None),
    (2, 1, "assistant", "b", None), (2, 1, "assistant", "a", None), (2, 0, None, None, None), (2, None, "user", "first", None),
    (None, 0, "assistant", "no id", None), (3, 0, "assistant", "x" * 300_000 + " é", None), (3, 1, "user", "\ud7ff🙂", None),
    (4, 0, "assistant", "same", None), (4, 0, "assistant", "same", None), (5, 0, "system<|text|>", "s", None),
]


def tables(folder):
    """Write all tables; returns the documents as (group, id, text, source)."""
    found, rows, labels = [], [], []
    for i, (group, text) in enumerate(texts()):
        source = None if i % 11 == 0 else "big" if i % 3 == 0 else f"s{i % 5}"
        found.append((group, i, text, source))
        rows.append((i, text, "xx", source, len(text or ""), *["clash"] * len(EXTRA)))
        labels.append((i, int(group != "junk"), int(group == "toxic"), None))
    rows += [rows[3], rows[3]]
    # Rows without an id, and different texts under one id; the first source has only such rows.
    for i in range(12):
        text, key = prose(random.Random(100 + i), 40 + 9 * i), None if i % 2 else 9_000
        found.append(("no id", key, text, "a"))
        rows.append((key, text, "xx", "a", len(text), *["clash"] * len(EXTRA)))
    rows += [rows[-1]] * 7
    found += [found[-1]] * 7
    labels += [labels[3], (None, 1, 0, None), (2, None, None, None)]
    leaky = next(t for g, _, t, _ in found if g == "leak")
    write(f"{folder}/documents.parquet", rows, DOCUMENTS)
    write(f"{folder}/labels.parquet", labels, LABELS)
    write(f"{folder}/pages.parquet", PAGE_ROWS, PAGES)
    write(f"{folder}/benchmark.parquet", [(*x, None) for x in benchmark(leaky)], ITEMS)
    write(f"{folder}/conversations.parquet", TURN_ROWS, TURNS)
    write(f"{folder}/embeddings.parquet", vectors(), VECTORS)
    return found


def empty_tables(folder):
    for name, schema in (("documents", DOCUMENTS), ("labels", LABELS), ("pages", PAGES), ("benchmark", ITEMS), ("conversations", TURNS), ("embeddings", VECTORS)):
        write(f"{folder}/{name}.parquet", [], schema)
