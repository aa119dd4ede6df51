"""Time the steps and models of the severity job, the intrusion job and single operators.

Prints one JSON line. BENCH_SF_DIR names the tables, BENCH_CPUS the threads and
BENCH_COPIES how many accident records are derived per event.
"""

from __future__ import annotations

import json
import os
import time

from rowsmith import build_session
from rowsmith import fixed_values as fixed
from rowsmith.functions import dates, text
from rowsmith.operators import columns as cols
from rowsmith.operators import encode, metrics, missing, models, split
from rowsmith.operators.columns import quoted
from rowsmith.plans import intrusion, severity
from rowsmith.plans.catalog import ENTRIES
from rowsmith.sources.delimited import read_delimited, write_delimited
from rowsmith.plans.catalog.derived_records import accident_records, intrusion_records
from rowsmith.storage import materialize, scratch_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
COPIES = int(os.environ.get("BENCH_COPIES", "70"))

PUBLISHED_ROWS = 7_000_000
PUBLISHED_SECONDS = {
    "csv_load": 48.26,
    "numeric_fill": 0.81,
    "drop_columns": 1.53,
    "simplify_wind": 4.30,
    "simplify_weather": 17.91,
    "date_features": 3.16,
    "categorical_fill": 2.43,
    "frequency_encoding": 14.25,
    "one_hot_encoding": 3.21,
    "binary_encoding": 69.40,
    "split": 3.42,
    "preparation": 196.72,
    "forest_train": 211.56,
    "logistic_train": 141.05,
}
OPERATORS = [
    "flagship_part_of_day", "class_distribution", "distinct_counts", "sum_by_key", "group_lists",
    "mean_fill", "median_fill", "missing_profile", "regex_bucket_last", "frequency_encode",
    "frequency_encode_hot_key", "index_by_frequency", "one_hot", "label_correlation",
    "stratified_split", "scale_columns", "weighted_f1", "area_under_roc", "csv_with_schema",
]


class Timer:
    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}

    def run(self, name, work):
        start = time.perf_counter()
        result = work()
        self.seconds[name] = round(time.perf_counter() - start, 3)
        return result


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def warm_up(spark, events) -> None:
    """Load classes and compile hot code before anything is timed."""
    severity.features(accident_records(events.repartition(CPUS)))
    consume(ENTRIES["flagship_part_of_day"].run(spark, SF_DIR))


def bench_steps(accidents, timer: Timer) -> None:
    """The steps for which single-machine times were published, one by one.

    Each runs on the columns it touches, as it would inside the whole job.
    """
    weather, wind = "Weather_Condition", ["Wind_Direction"]
    moment = dates.parse_timestamp(quoted("Start_Time"))
    hour = dates.hour_of(moment)
    text_columns = accidents.select(*fixed.ACCIDENT_TEXT)
    frequency = accidents.select(*fixed.ACCIDENT_FREQUENCY)
    bucket = text.bucket_last(quoted(weather), fixed.WEATHER_PATTERNS).alias(weather)
    bucketed = materialize(accidents.select(bucket, "Timezone"), "bench_weather")
    steps = {
        "numeric_fill": lambda: missing.fill_mean(
            accidents.select(*[quoted(c) for c in fixed.ACCIDENT_NUMERIC]), fixed.ACCIDENT_NUMERIC
        ),
        "drop_columns": lambda: cols.drop_columns(accidents, fixed.ACCIDENT_UNUSED),
        "simplify_wind": lambda: cols.map_values(
            accidents.select(*wind), fixed.COMPASS_POINTS, wind
        ),
        "simplify_weather": lambda: accidents.select(bucket),
        "date_features": lambda: accidents.select(
            hour, dates.day_of_week(moment), dates.month(moment), dates.year(moment),
            dates.part_of_day(hour), dates.day_flag(hour),
        ),
        "categorical_fill": lambda: missing.fill_text(text_columns, fixed.ACCIDENT_TEXT),
        "frequency_encoding": lambda: encode.FrequencyEncoder.fit(
            frequency, fixed.ACCIDENT_FREQUENCY
        ).transform(frequency),
        "one_hot_encoding": lambda: encode.one_hot(bucketed, fixed.ACCIDENT_ONE_HOT),
        "binary_encoding": lambda: encode.binary_flags(
            accidents.select(*fixed.ACCIDENT_FLAGS), fixed.ACCIDENT_FLAGS
        ),
        "split": lambda: split.stratified_split(
            accidents.select(fixed.ACCIDENT_LABEL, "ID"), fixed.ACCIDENT_LABEL, "ID"
        ),
    }
    for name, step in steps.items():
        timer.run(name, lambda: consume(step()))


def bench_severity(spark, events, timer: Timer) -> int:
    path = scratch_path(spark, "bench_accidents")
    records = accident_records(events.repartition(4 * CPUS), COPIES)
    write_delimited(records, path)
    raw = read_delimited(spark, path, fixed.ACCIDENT_SCHEMA)
    accidents = timer.run("csv_load", lambda: materialize(raw, "bench_accidents"))
    bench_steps(accidents, timer)
    table = timer.run("preparation", lambda: severity.features(raw))
    train, test = split.parts(table, severity.SPLIT)
    # As in the job: one preparation, shared by both models.
    ready = models.fit_preparation(train, fixed.ACCIDENT_FEATURES)
    train, test = ready.transform(train), ready.transform(test)
    for name, estimator in (
        ("forest_train", models.forest(fixed.ACCIDENT_LABEL)),
        ("logistic_train", models.logistic(fixed.ACCIDENT_LABEL)),
    ):
        fit = lambda: estimator.fit(train)
        model = timer.run(name, fit)
        scored = metrics.classification_metrics(model.transform(test), fixed.ACCIDENT_LABEL)
        timer.run(name.replace("train", "evaluate"), scored.first)
    return accidents.count()


def bench_intrusion(spark, events, timer: Timer) -> None:
    records = materialize(intrusion_records(events.repartition(4 * CPUS)), "bench_intrusions")
    train, test = (p.drop("row_id") for p in split.parts(split.random_split(records, "row_id")))
    timer.run("intrusion_job", lambda: intrusion.run(train, test).first())


def main() -> None:
    spark = build_session(
        "rowsmith-bench",
        f"local[{CPUS}]",
        {
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": str(2 * CPUS),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    timer = Timer()
    warm_up(spark, events)
    for name in OPERATORS:
        timer.run(name, lambda: consume(ENTRIES[name].run(spark, SF_DIR)))
    bench_intrusion(spark, events, timer)
    rows = bench_severity(spark, events, timer)
    ours = {k: round(rows / timer.seconds[k]) for k in PUBLISHED_SECONDS}
    published = {k: round(PUBLISHED_ROWS / s) for k, s in PUBLISHED_SECONDS.items()}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timer.seconds.values()), 3),
                "unit": "sec",
                "queries": timer.seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "severity_rows": rows,
                "rows_per_second": ours,
                "published_rows_per_second": published,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
