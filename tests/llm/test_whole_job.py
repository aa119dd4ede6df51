"""Rows on which operators once did less than the whole job."""

import itertools
import random
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F
from rowsmith.llm import chat, crf, decontaminate, gru, line_dedup, line_rules, mixing, simhash, tables, url_filter


def letters(n):
    """Digits count as one character in lines, so numbers are written in letters."""
    return "".join(chr(97 + int(d)) for d in str(n))


def prose(i, n=60):
    return " ".join(f"own{letters(i)}x{letters(k)}" for k in range(n))


def test_line_of_few_documents_of_a_large_source_is_boilerplate(spark):
    footer = " ".join(f"shared{letters(i)}" for i in range(80))
    rows = [(i, prose(i) + ("\n" + footer if i < 30 else ""), "big") for i in range(2_000)]
    rows += [(2_000 + i, prose(2_000 + i) + "\n" + footer, "small") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["doc_id"]: (r["base_failed"], r["removed_lines"], r["kept"]) for r in line_rules.verdicts(docs).collect()}
    assert found == {i: (False, [1], False) if i < 30 else (False, [], True) for i in range(2_020)}


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_lines_are_removed_row_by_row(spark):
    first, second, shared = prose(1, 9), prose(2, 9), prose(3, 9)
    for key in (None, 7):
        docs = frame(spark, [(key, f"{shared}\n{first}"), (key, f"{second}\n{shared}"), (key, f"{prose(4, 9)}\n{prose(5, 9)}")])
        found = sorted(r["text"] for r in line_dedup.deduplicated(docs.coalesce(1)).collect())
        assert found == sorted([f"{shared}\n{first}", second, f"{prose(4, 9)}\n{prose(5, 9)}"])


def test_near_copies_are_dropped_row_by_row(spark):
    one, two = prose(1), prose(2)
    docs = frame(spark, [(None, one), (None, one), (None, two), (7, two), (5, prose(3)), (5, prose(3)), (5, prose(4))])
    found = sorted((r["doc_id"] or 0, r["text"]) for r in simhash.keep_one(docs).collect())
    assert found == sorted([(0, one), (0, two), (5, prose(3)), (5, prose(4))])


def test_documents_are_decontaminated_row_by_row(spark):
    item, leak = prose(1, 30), prose(2) + "\n" + prose(1, 30)
    docs = frame(spark, [(None, leak), (None, prose(3)), (5, leak), (5, prose(4))])
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = sorted((r["doc_id"] or 0, r["text"]) for r in decontaminate.decontaminated(docs, items).collect())
    assert found == sorted([(0, prose(3)), (5, prose(4))])


def test_short_and_unspaced_lines_are_compared(spark):
    code = "".join(letters(i * 7_919) for i in range(100))
    rows = [(1, f"Hi\n漢字仮名交文\n{code}\na"), (2, f"hI \nHo\n漢字仮名交文\n{code[:-1]}z\nb"), (3, "a\u0000\nHo")]
    found = {tuple(r)[:4] for r in line_dedup.repeated_lines(frame(spark, rows)).collect()}
    same = [((1, 0), (2, 0)), ((1, 1), (2, 2)), ((1, 2), (2, 3)), ((2, 1), (3, 1))]
    assert found == {(*at, *pair[0]) for pair in same for at in pair}


LINKS = [
    ("/de/9", "http://shop.com/de/9"), ("de/9", "http://shop.com/xx/de/9"), ("//O.com/x", "http://O.com/x"),
    ("../de/./9?a=/../b", "http://shop.com/de/9?a=/../b"), ("../../..", "http://shop.com/"), (".", "http://shop.com/xx/"),
    ("?b", "http://shop.com/xx/9?b"), ("/to?u=http://q.com/x", "http://shop.com/to?u=http://q.com/x"),
    ("ftp://q.com/../x", "ftp://q.com/../x"), ("mailto:a@b.c", None),
]


@pytest.mark.parametrize("target, meant", LINKS)
def test_links_are_resolved(spark, target, meant):
    row = spark.createDataFrame([("http://shop.com/xx/9?q#f", target)], "url string, t string")
    assert row.select(url_filter.resolved(F.col("t"), F.col("url"))).first()[0] == meant


def test_relative_links_make_aliases(spark):
    rows = [
        (0, "http://shop.com/xx/9", "<meta http-equiv=refresh content='0;url=/de/9'>"),
        (1, "http://b.net/y", "<link rel=canonical href='//shop.com/xx/9'>"), (2, "http://b.net/a/z", "<link rel=canonical href=../y>"),
        (3, "http://b.net", "<link rel=canonical href=y>"), (4, "http://b.net/q", "<link rel=canonical href='#y'>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages).collect()}
    assert found == {0: "block", 1: "block", 2: "block", 3: "block", 4: "allow"}


def test_short_items_are_found_inside_long_documents(spark):
    items = spark.createDataFrame(
        [(1, "Capital of France is"), (2, "capital of france is paris"), (3, "dolor"), (4, "is of"), (5, "?")], "item_id long, text string"
    )
    docs = frame(spark, [(10, "lorem ipsum the capital of france is paris dolor"), (11, "Dolor."), (12, prose(1)), (13, "capital of france")])
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, items).collect()}
    assert found == {(10, 1), (10, 2), (10, 3), (11, 3)}
    left = {r["doc_id"] for r in decontaminate.decontaminated(docs, items).collect()}
    assert left == {12, 13}


BORDERS = sorted({n for low in decontaminate.SIZE_PARTITIONS for n in (low - 1, low, low + 1) if n})


def test_items_at_every_border_of_the_size_partitions(spark):
    items, docs, expected = [], [], set()
    for n in BORDERS:
        words = [f"item{letters(n)}x{letters(i)}" for i in range(n + 4)]
        items.append((n, " ".join(words)))
        enough = -(-n * 4 // 5)
        for start in range(0, n - enough + 1):
            docs.append((1_000 * n + start, f"{prose(n)} {' '.join(words[start : start + enough + 4])} {prose(n + 1)}"))
            expected.add((1_000 * n + start, n, n, enough))
        docs.append((-n, f"{prose(n)} {' '.join(words[: enough + 3])} {prose(n + 1)}"))
    found = decontaminate.matches(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in found.collect()} == expected


def test_draws_reach_the_recall_they_promise():
    for partition, low in enumerate(decontaminate.SIZE_PARTITIONS):
        high = (*decontaminate.SIZE_PARTITIONS, 5_000)[partition + 1]
        draws = decontaminate.draws_for(partition)
        assert draws <= 8 and max(decontaminate.miss(n, draws) for n in range(low, high)) <= 1e-5


@pytest.mark.parametrize("copies", [0, 37])
def test_sources_without_ids_meet_their_targets(spark, copies):
    r = random.Random(copies)
    rows = [(None if i % 2 else 7, prose(i, r.randint(1, 40)), "a") for i in range(100)] + [(3, prose(1_000, 11), "a")] * copies
    rows += [(i, prose(i, 30), "b") for i in range(100, 200)] + [(None, "same text", "c")] * 500
    docs = spark.createDataFrame([(*x, "clash", "clash") for x in rows], "doc_id long, text string, source string, __row string, turn string")
    for seed in range(3):
        sized, plan = mixing.plan_for(docs.repartition(3), seed=seed)
        found = mixing.sample(sized, plan, "size", "turn", "row").groupBy("source").agg(
            F.sum("taken"), F.max("target"), F.max(F.col("taken") - 3 * F.col("size"))
        ).collect()
        assert len(found) == 3
        for source, taken, target, over in found:
            assert abs(taken - target) <= 0.5 and over <= 0, (seed, source)


def test_lines_go_in_time_proportional_to_the_text(spark):
    n = 200_000
    text = "\n".join(f"line {letters(i)}" for i in range(n))
    row = spark.createDataFrame([(text, list(range(0, n, 2)))], "t string, p array<int>")
    began = time.time()
    found = row.select(tables.without_places(F.col("t"), F.col("p"))).first()[0]
    assert time.time() - began < 10
    assert found.split("\n") == [f"line {letters(i)}" for i in range(1, n, 2)]


def test_depleted_documents_go(spark):
    base = [prose(i, 9) for i in range(10)]
    whole = "\n".join(base)
    docs = frame(spark, [
        (1, whole), (2, whole), (3, "\n".join([*base[:9], prose(50, 9)])), (4, "\n".join([*base[:7], prose(60, 27)])), (5, ""), (6, None),
    ])
    found = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(docs).collect()}
    assert found == {1: whole, 4: prose(60, 27), 5: "", 6: None}


def test_line_shingles_are_characters():
    for text in ("plain ascii line", "naïve café au lait", "naïve café œuvre au lait", "é", "漢字仮名交文漢字仮名", "字", "ab", "aé" * 30):
        line = line_dedup.normal_line(text)
        assert len(line_dedup.shingle_set(line)) == len({text[i : i + 8] for i in range(max(1, len(text) - 7))})
    one, two = (line_dedup.shingle_set(line_dedup.normal_line(t)) for t in ("é the same tail", "e the same tail"))
    assert line_dedup.jaccard(one, two) == 7 / 9


def test_gradients_of_the_network_equal_differences():
    r = np.random.default_rng(4)
    network = gru.Network.start(r.normal(size=gru.WORD_BUCKETS), r.normal(size=gru.GRAM_BUCKETS), 1)
    # Differences need more digits than the network is trained with.
    network.weights = {k: x.astype(float) for k, x in network.weights.items()}
    words = gru.hashed_words(["ab", "idiot", "c", "hello", "wörld"])
    index, lengths, labels = np.array([[0, 1, 2, 3], [4, 1, 0, 0], [2, 2, 3, 1]]), np.array([4, 2, 3]), np.array([1, 0, 1])

    def loss():
        logits = network.run(network.gates(network.word_inputs(*words)), index, lengths)
        return np.mean(np.logaddexp(0, logits) - labels * logits)

    found = network.gradients(words, index, lengths, labels)
    for name, values in network.weights.items():
        places = np.argwhere(found[name] != 0) if name in ("words", "grams") else np.argwhere(np.ones(values.shape))
        for at in map(tuple, places[r.permutation(len(places))[:12]]):
            kept, losses = values[at], []
            for step in (1e-2, -1e-2):
                values[at] = kept + step
                losses.append(loss())
            values[at] = kept
            assert (losses[0] - losses[1]) / 2e-2 == pytest.approx(found[name][at], abs=2e-4, rel=2e-2), (name, at)


def test_marginals_equal_all_labellings():
    r = np.random.default_rng(6)
    lengths = np.array([3, 1, 5, 2])
    scores, links = r.normal(size=lengths.sum()) * 2, r.normal(size=(2, 2))
    good, pairs = crf.marginals(scores, links, crf.Chains(lengths))
    expected_pairs, at = np.zeros((2, 2)), 0
    for n in lengths:
        weight, chance, seen = 0.0, np.zeros(n), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(scores[at + i] for i, y in enumerate(labels) if y) + sum(links[a, b] for a, b in zip(labels, labels[1:])))
            weight += w
            chance += w * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                seen[a, b] += w
        assert good[at : at + n] == pytest.approx(chance / weight)
        expected_pairs += seen / weight
        at += n
    assert pairs == pytest.approx(expected_pairs)


TURNS = [
    (1, 0, "user", "Hi <|end|>\\ <|assistant|>"), (1, 1, "assistant", "  café \\n <|turn|> 漢字🙂 "), (1, 2, "assistant", ""),
    (1, 3, "assistant", "twice"), (1, 4, "assistant", " in a row"), (1, 5, "system<|text|>", "x" * 50), (2, 0, "assistant", "é" * 90),
    (2, None, "user", "first"), (None, 0, "assistant", "no id"), (3, 0, "user", None), (3, 1, None, "nobody"),
]


@pytest.mark.parametrize("window", [1, 60, 1 << 18])
def test_runs_joined_are_the_conversation_encoded_once(spark, window):
    turns = spark.createDataFrame([(*t, "clash", "clash") for t in TURNS], "conv_id long, turn long, role string, text string, run string, ids string")
    runs = {}
    for r in chat.format_conversations(turns, window=window).collect():
        runs.setdefault(r["conv_id"], []).append(r)
    tokenizer = chat.load_tokenizer()
    assert set(runs) == {1, 2, 3, None}
    for conv, rows in runs.items():
        rows.sort(key=lambda r: r["run"])
        assert [r["run"] for r in rows] == list(range(len(rows)))
        own = sorted((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in TURNS if t[0] == conv)
        whole = "".join(chat.render(role, text) for _, _, role, text in own)
        encoding = tokenizer.encode(whole, add_special_tokens=False)
        assert "".join(r["formatted"] for r in rows) == whole
        assert [i for r in rows for i in r["ids"]] == encoding.ids
        assert [x for r in rows for x in r["loss"]] == chat.loss_mask(whole, encoding.offsets)
        found = [t for r in rows for t in chat.masked_texts(r["formatted"], *(np.array(r[c]) for c in ("starts", "ends", "loss")))]
        assert found == [text for _, _, role, text in own if role == "assistant" and text]


def test_a_hot_band_is_cut_by_rare_shingles(spark, monkeypatch):
    """Lines of one bucket that its smallest line does not connect: no link is lost, and few lines meet."""
    monkeypatch.setattr(line_dedup, "TILE", 64)
    monkeypatch.setattr(line_dedup, "MAX_TILES", 4)
    r = random.Random(8)
    shared = "this passage stands in every line of the bucket"
    lines = [f"{shared} {prose(i, 12)}" for i in range(1_500)]
    for i in range(0, 1_500, 10):  # near copies in pairs and chains
        words = lines[i].split()
        words[r.randrange(9, len(words))] = "changed"
        lines[i + 1] = " ".join(words)
        if i % 50 == 0:
            words[r.randrange(9, len(words))] = "again"
            lines[i + 2] = " ".join(words)
    encoded = [line_dedup.normal_line(x) for x in lines]
    text_of = spark.createDataFrame([(i, bytearray(x)) for i, x in enumerate(encoded)], "node long, line binary")
    members = spark.createDataFrame([(7, 0, i) for i in range(len(lines))], "value long, head long, node long")
    star = spark.createDataFrame([(1, 0), (0, 0)], "node long, component long")
    met = []
    parted = line_dedup._parted
    monkeypatch.setattr(line_dedup, "_parted", lambda *x: met.append(parted(*x)) or met[0])
    found = line_dedup._further_links(members, star, text_of).collect()
    sets = [line_dedup.shingle_set(x) for x in encoded]
    near = [(i, j) for i in range(len(lines)) for j in range(i + 1, min(i + 12, len(lines))) if line_dedup.jaccard(sets[i], sets[j]) >= 0.8]
    label = list(range(len(lines)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    def classes(pairs):
        label[:] = range(len(lines))
        for a, b in pairs:
            one, two = sorted((find(a), find(b)))
            label[two] = one
        return [find(i) for i in range(len(lines))]

    assert len(near) > 150
    assert classes([(0, 1), *[(a, b) for a, b in found]]) == classes([(0, 1), *near])
    # Without the cut each of 1,500 lines would go to 24 tiles.
    assert met[0].count() < 6 * len(lines)


def test_a_slot_set_comes_to_the_driver_as_bytes(spark):
    rows = spark.range(0, 400_000, 1, 8).select(F.xxhash64("id").alias("number"))
    numbers = rows.toPandas()["number"].to_numpy()
    tracemalloc.start()
    found = tables.slot_set(rows, "number")
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    # The set itself takes 16 MB; rows of Python numbers would take far more than the rest.
    assert peak < 40e6
    expected = np.zeros(1 << (tables.SLOT_BITS - 6), np.int64)
    np.bitwise_or.at(expected, (numbers >> 6) & (len(expected) - 1), np.int64(1) << (numbers & 63))
    assert (found == expected).all()
    assert tables.in_slots(found, numbers).all()


def test_a_slot_set_of_nothing_is_empty(spark):
    assert not tables.slot_set(spark.range(0).select(F.col("id").alias("number")), "number").any()
