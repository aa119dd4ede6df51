"""Every query on planted tables against SQL or brute force, and on empty tables."""

import hashlib
import re
import zlib
from collections import Counter

import planted
import pytest
import xxhash
from oracle import connect, differences
from rowsmith.llm.queries import ESCAPE_PROBE, QUERIES
from rowsmith.llm.sql import ORACLE

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("planted")


@pytest.fixture(scope="module")
def docs(folder):
    found = planted.tables(folder)
    # Two further rows repeat the row of document 3.
    return found + [found[3], found[3]]


@pytest.fixture(scope="module")
def results(spark, folder, docs):
    kept = {}

    def run(name):
        if name not in kept:
            kept[name] = QUERIES[name](spark, str(folder)).collect()
        return kept[name]

    return run


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql_on_planted_rows(spark, folder, docs, name):
    sql = ORACLE[name]
    assert differences(QUERIES[name](spark, str(folder)), connect(folder), sql) == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) == []


@pytest.mark.parametrize("name", ["op5_license_scan", "op8_url_filter", "op9_decontamination"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop") if x in plan]


def components(nodes, linked):
    label = {n: n for n in nodes}

    def find(n):
        while label[n] != n:
            n = label[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                one, two = sorted((find(a), find(b)))
                label[two] = one
    return {n: find(n) for n in nodes}


def brute_fingerprint(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_equals_brute_force(docs, results):
    fps = [brute_fingerprint(t) for _, _, t, _ in docs]
    group = components(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 4)
    smallest = {}
    for (_, i, _, _), fp in zip(docs, fps):
        known = smallest.get(group[fp])
        smallest[group[fp]] = i if known is None else known if i is None else min(i, known)
    expected = Counter((i, f"{fp:016x}", smallest[group[fp]]) for (_, i, _, _), fp in zip(docs, fps))
    assert Counter(map(tuple, results("op10_simhash"))) == expected
    assert len({group[fp] for (g, _, _, _), fp in zip(docs, fps) if g in ("copy", "near")}) == 1


def test_line_dedup_equals_brute_force(docs, results):
    lines = {}
    for _, i, text, _ in docs:
        for place, line in enumerate((text or "").split("\n")):
            if line.split():
                lines.setdefault(" ".join(line.lower().split()), set()).add((i, place))
    sets = {x: {x[i : i + 8] for i in range(max(1, len(x) - 7))} for x in lines}
    holders = {}
    for x in sorted(lines):
        for shingle in sets[x]:
            holders.setdefault(shingle, []).append(x)

    def similar(a, b):
        return len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])

    # Lines without a common shingle are not similar.
    group = {x: x for x in lines}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for x in sorted(lines):
        for other in {y for shingle in sets[x] for y in holders[shingle] if y > x}:
            if similar(x, other):
                one, two = sorted((find(x), find(other)))
                group[two] = one
    members = {}
    for x, places in lines.items():
        members.setdefault(find(x), set()).update(places)

    def order(at):
        return (at[0] is not None, at[0] or 0, at[1])

    firsts = {root: min(places, key=order) for root, places in members.items()}
    expected = {(*at, *firsts[root], at == firsts[root]) for root, places in members.items() if len(places) > 1 for at in places}
    rows = Counter(i for _, i, _, _ in docs)
    found = {tuple(r) for r in results("op4_line_dedup")}
    # Lines of a document whose row repeats are listed for each of its rows.
    alone = {x for x in found - expected if rows[x[0]] > 1 and x[4]}
    assert found - alone == expected


def test_chat_digests(results):
    turns = {}
    for conv, turn, role, text, _ in planted.TURN_ROWS:
        turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns[-7] = [(True, 0, "user", ESCAPE_PROBE), (True, 1, "assistant", ESCAPE_PROBE)]
    found = {r["conv_id"]: r for r in results("op6_chat_format")}
    assert set(found) == set(turns)
    for conv, rows in turns.items():
        rows.sort()
        loss = "".join(t for _, _, role, t in rows if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for _, _, role, t in rows)
        r = found[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(rows), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["formatted_chars"] >= len(whole) - 2 * len(rows)


def test_mix_meets_its_targets(docs, results):
    source = {i: s for _, i, _, s in docs}
    taken, target, size = Counter(), {}, Counter()
    for r in results("op1_source_mixing"):
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        size[s] += r["size"]
        target[s] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert "a" in target
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    for s, t in target.items():
        assert t <= 3 * size[s] and abs(taken[s] - t) <= 3


@pytest.mark.parametrize("name, good, bad, threshold", [
    ("op2_toxicity", "toxic", "clean", 0.3), ("op7_line_quality", "clean", "junk", 0.7),
])
def test_classifiers_on_held_out_rows(docs, results, name, good, bad, threshold):
    group = {i: g for g, i, _, _ in docs}
    rows = results(name)
    assert Counter(r["doc_id"] for r in rows) == Counter(i for _, i, _, _ in docs)
    for r in rows:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
    tested = [(group[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"]]
    right = [p == (g == good) for g, p in tested if g in (good, bad)]
    assert len(right) > 10 and sum(right) >= 0.9 * len(right)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    planted.empty_tables(tmp_path)
    rows = QUERIES[name](spark, str(tmp_path)).collect()
    assert [r["conv_id"] for r in rows] == [-7] if name == "op6_chat_format" else rows == []


def test_pipeline(spark, folder, docs):
    columns = spark.read.parquet(f"{folder}/documents.parquet").columns
    kept = spark.read.parquet(f"{folder}/documents.parquet")
    by_group = {}
    for g, i, _, _ in docs:
        by_group.setdefault(g, set()).add(i)
    left = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept, str(folder))
        path = f"{folder}/stage{i}"
        out.write.parquet(path)
        kept = spark.read.parquet(path)
        left[name] = kept.collect()
        assert kept.columns[: len(columns)] == columns
        assert name == "source_mixing" or kept.columns == columns
    ids = {name: {r["doc_id"] for r in rows} for name, rows in left.items()}
    assert not by_group["toxic"] & ids["toxicity"]
    assert by_group["clean"] <= ids["benchmark_decontamination"]
    assert len((by_group["copy"] | by_group["near"]) & ids["simhash_near_dedup"]) == 1
    assert not by_group["leak"] & ids["benchmark_decontamination"]
    texts = {r["doc_id"]: r["text"] for r in left["line_dedup"]}
    # Four words of an item that follow each other somewhere are no leak, and rows without an id are judged one by one.
    own = {t for g, _, t, _ in docs if g == "no id"}
    assert {r["text"] for r in left["benchmark_decontamination"]} >= own
    assert all(len(r["text"]) == r["n_chars"] for r in left["line_dedup"] if r["text"] is not None)
    shared = [texts[i] for i in sorted(by_group["shared"])]
    line = max(shared[0].split("\n"), key=len)
    assert [t.count(line) for t in shared] == [1] + [0] * (len(shared) - 1)
    words = Counter()
    for r in left["source_mixing"]:
        words[r["source"]] += r[-1]  # copy_words, with underscores in front, as the documents have such a column
    assert sum(words.values()) == pytest.approx(sum(len(WORD.findall(r["text"] or "")) for r in left["benchmark_decontamination"]), abs=20)


def test_pipeline_on_empty_tables(spark, tmp_path):
    planted.empty_tables(tmp_path)
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
