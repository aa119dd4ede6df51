"""Mixing sources to target weights by capped water-filling and seeded sampling.

Targets share a total by weight. A source whose share exceeds ``max_epochs`` times its size
is clamped there, and its excess is shared among the others by weight, until none is above.
Each round is one aggregation of the source table; all amounts are whole numbers until the
last division, so the result does not depend on the order of addition.

A source then takes whole repetitions of all its documents and one fractional repetition:
documents in the order of a seeded hash of id and text until the target is met, the last of them
in part. The place in that order is found by sums per hash bucket (two levels of 4,096) and a
sort of the one bucket that is left, so no task ever sorts a source. Only repeated rows have one
hash; where the target falls among them, the order of the rows in their files decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm.tables import Scratch, fresh, numbered, quoted, word_count
from rowsmith.operators.lookup import KeyTable, attach
from rowsmith.operators.ordering import row_numbers

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 20_240_601
_BUCKET_BITS = 12
_TURN_BITS = 60


def sizes(
    rows: DataFrame, row: str, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """(doc_id, source, size, turn, row): words per row, its place in the order, and what it is known by.

    ``rows`` and ``row`` are from ``numbered``. A null text has no words.
    """
    return rows.select(
        quoted(doc_id).alias("doc_id"), quoted(source).alias("source"), word_count(quoted(text)).alias("size"),
        _turn(quoted(doc_id), quoted(text), seed).alias("turn"), quoted(row).alias("row"),
    )


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(source, n, source_size, weight, target): water-filled targets that sum to all sizes.

    Sources are ordered by code point, null last, and weigh ``weights`` in turn. A source
    without words has target 0 and its weight goes to the others.
    """
    scratch = Scratch(sized.sparkSession)
    counted = sized.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size")
    )
    place = row_numbers(counted, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.expr(f"int(place % {len(weights)}) + 1"))
    sources, _ = scratch.write(
        place.select("source", "n", "source_size", weight.cast("long").alias("weight")), "sources"
    )
    room = F.col("source_size") * max_epochs
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    left, shares, clamped = total, 0, None
    while True:
        is_clamped = _exceeds(room, left, shares)
        row = sources.agg(
            F.count_if(is_clamped),
            F.coalesce(F.sum(F.when(is_clamped, room)), F.lit(0)),
            F.coalesce(F.sum(F.when(~is_clamped, F.col("weight"))), F.lit(0)),
        ).first()
        if row[0] == clamped:
            break
        # Clamping only ever raises the share of the others, so each round clamps more.
        clamped, left, shares = row[0], total - row[1], row[2]
    share = F.col("weight") * F.lit(left).cast("double") / F.lit(max(1, shares)).cast("double")
    return sources.withColumn(
        "target", F.when(_exceeds(room, left, shares), room.cast("double")).otherwise(share)
    )


def _exceeds(room: Column, left: int, shares: int) -> Column:
    """Is the share ``left * weight / shares`` at or above ``room``? Exact; never for no shares."""
    if not shares:
        return F.col("source_size") == 0
    big = "decimal(19,0)"
    share = F.col("weight").cast(big) * F.lit(left).cast(big)
    return room.cast(big) * F.lit(shares).cast(big) <= share


def _turn(doc_id: Column, text: Column, seed: int) -> Column:
    """Where a document stands in the order of its source: a hash of id and text, 60 bits, not negative."""
    parts = [F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))]
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), *parts)), 1, _TURN_BITS // 4), 16, 10).cast("long")


def _bucket(level: int) -> Column:
    return F.shiftright("turn", _TURN_BITS - _BUCKET_BITS * level).bitwiseAND(F.lit((1 << _BUCKET_BITS) - 1))


def sampling_plan(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with (whole, cut_turn, cut_words, cut_row): how each source is sampled.

    Every document is taken ``whole`` times. Documents whose turn is below ``cut_turn`` are taken
    once more, and of the document at ``cut_turn`` ``cut_words`` words. If repeated rows share that
    turn, those before ``cut_row`` are taken once more and of that row ``cut_words`` words.
    """
    scratch = Scratch(sized.sparkSession)
    wanted = F.round("target").cast("long")
    has_words = F.col("source_size") > 0
    plan, _ = scratch.write(
        targets.withColumns(
            {
                "whole": F.when(has_words, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0),
                "need": F.when(has_words, wanted % F.col("source_size")).otherwise(0),
            }
        ),
        "mix_plan",
    )
    turns = sized.filter("size > 0")
    open_ = plan.filter("need > 0").select(F.col("source").alias("from"), "need")
    # A row per source and bucket; the buckets of a source fit one task.
    counted = turns.groupBy("source", _bucket(1).alias("b1")).agg(F.sum("size").alias("inside"))
    first, _ = scratch.write(
        _boundary(counted.join(open_, F.col("source").eqNullSafe(F.col("from"))).drop("from"), ["source"], ["b1"]),
        "mix_cut",
    )
    counted = _within(turns, first, ["b1"]).groupBy("source", "b1", "need", _bucket(2).alias("b2")).agg(
        F.sum("size").alias("inside")
    )
    second, _ = scratch.write(_boundary(counted, ["source"], ["b2"], ["b1"]), "mix_cut")
    rows = _within(turns, second, ["b1", "b2"]).groupBy("source", "turn", "need").agg(
        F.sum("size").alias("inside"), F.count(F.lit(1)).alias("ties")
    )
    cut, _ = scratch.write(
        _boundary(rows, ["source"], ["turn"], ["inside", "ties"]).select(
            F.col("source").alias("from"), F.col("turn").alias("cut_turn"), "need", "ties", F.expr("inside div ties").alias("each")
        ),
        "mix_cut",
    )
    known = plan.drop("need").join(_cut_rows(turns, cut), F.col("source").eqNullSafe(F.col("from")), "left").drop("from")
    written, path = scratch.write(known.fillna(0, ["cut_turn", "cut_words"]), "mix_sampling")
    scratch.drop_all(but=[path])
    return written


def _cut_rows(turns: DataFrame, cut: DataFrame) -> DataFrame:
    """(from, cut_turn, cut_words, cut_row); no row where a single one, or all of equal ones, stands at the cut."""
    alone = cut.filter("ties = 1 or need = each * ties").select(
        "from", "cut_turn", F.least("need", "each").alias("cut_words"), F.lit(None).cast(turns.schema["row"].dataType).alias("cut_row")
    )
    shared = cut.filter("ties > 1 and need < each * ties")
    if shared.isEmpty():
        return alone
    same = F.col("source").eqNullSafe(F.col("from")) & (F.col("turn") == F.col("cut_turn"))
    tied = turns.join(F.broadcast(shared), same).select("from", "cut_turn", "need", "each", "row")
    placed = row_numbers(tied, [F.col("from"), F.col("row")], "place")
    starts = placed.groupBy(F.col("from").alias("of")).agg(F.min("place").alias("start"))
    rank = F.col("place") - F.col("start")
    found = placed.join(F.broadcast(starts), F.col("from").eqNullSafe(F.col("of"))).filter(rank == F.expr("need div each"))
    return alone.union(found.select("from", "cut_turn", (F.col("need") % F.col("each")).alias("cut_words"), F.col("row").alias("cut_row")))


def _boundary(counted: DataFrame, by: list[str], order: list[str], more: Sequence[str] = ()) -> DataFrame:
    """The bucket in which a source's ``need``-th word lies; need becomes the words missing in it."""
    upto = F.sum("inside").over(
        Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    before = F.col("upto") - F.col("inside")
    return (
        counted.withColumn("upto", upto)
        .filter((before < F.col("need")) & (F.col("need") <= F.col("upto")))
        .select(*by, *order, *more, (F.col("need") - before).alias("need"))
    )


def _within(turns: DataFrame, found: DataFrame, buckets: list[str]) -> DataFrame:
    """Rows of the boundary buckets. Rows of other buckets go before any shuffle by source."""
    key = F.col("source").eqNullSafe(F.col("from"))
    marked = turns.withColumns({f"of_{b}": _bucket(i + 1) for i, b in enumerate(buckets)})
    for b in buckets:
        key = key & (F.col(f"of_{b}") == F.col(b))
    return marked.join(found.withColumnRenamed("source", "from"), key)


def sample(rows: DataFrame, plan: DataFrame, size: str, turn: str, row: str, source: str = "source") -> DataFrame:
    """``rows`` with (source_size, target, taken); clashing names get underscores in front.

    The names are those of the columns of ``rows`` that hold what ``sizes`` computes.
    """
    payload = ("source_size", "target", "whole", "cut_turn", "cut_words", "cut_row")
    inner = {p: fresh(rows, f"__{p}") for p in payload}
    known = plan.select(F.col("source").alias("key"), "n", *[F.col(p).alias(inner[p]) for p in payload])
    found = attach(rows, quoted(source), KeyTable.measured(known, tuple(inner.values())), null_safe=True)
    own, at, cut = quoted(size), quoted(turn), {p: quoted(name) for p, name in inner.items()}
    tied = (
        F.when(cut["cut_row"].isNull(), F.least(own, cut["cut_words"]))
        .when(quoted(row) < cut["cut_row"], own)
        .when(quoted(row) == cut["cut_row"], cut["cut_words"])
        .otherwise(0)
    )
    more = F.when(at < cut["cut_turn"], own).when(at == cut["cut_turn"], tied).otherwise(0)
    out = {"source_size": cut["source_size"], "target": cut["target"], "taken": cut["whole"] * own + more}
    return found.select(
        *[quoted(c) for c in rows.columns], *[value.alias(fresh(rows, name)) for name, value in out.items()]
    )


def plan_for(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """(``sizes`` per row, sampling plan per source) of ``docs``; the sizes are written once."""
    sized, _ = Scratch(docs.sparkSession).write(sizes(*numbered(docs), seed, doc_id, text, source), "mix_sizes")
    return sized, sampling_plan(sized, source_targets(sized, weights, max_epochs))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mixed corpus: a row per copy, with (copy, copy_words) beside the columns of ``docs``.

    ``copy`` counts from 0. ``copy_words`` is the number of words the mix uses of this copy:
    all of them, but for the one document per source at which its target is met. Documents of
    which nothing is taken are gone; so are texts without words. Rows that share an id, or have
    none, are documents of their own. No documents: no rows.
    """
    rows, row = numbered(docs)
    scratch = Scratch(docs.sparkSession)
    sized, path = scratch.write(sizes(rows, row, seed, doc_id, text, source), "mix_sizes")
    plan = sampling_plan(sized, source_targets(sized, weights, max_epochs))
    scratch.drop(path)
    size, turn = fresh(rows, "__size"), fresh(rows, "__turn")
    marked = rows.withColumns({size: word_count(quoted(text)), turn: _turn(quoted(doc_id), quoted(text), seed)})
    taken = sample(marked, plan, size, turn, row, source)
    words, of_copy = quoted(fresh(marked, "taken")), fresh(taken, "__copy")
    own, copy = quoted(size), quoted(of_copy)
    copies = F.sequence(F.lit(0), F.ceil(words / own).cast("int") - 1)
    return (
        taken.filter((own > 0) & (words > 0))
        .withColumn(of_copy, F.explode(copies))
        .select(
            *[quoted(c) for c in docs.columns],
            copy.alias(fresh(docs, "copy")),
            F.least(own, words - own * copy).alias(fresh(docs, "copy_words")),
        )
    )
