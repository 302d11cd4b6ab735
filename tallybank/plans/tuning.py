"""Experiments around the queries: plans, settings, caching, UDF cost and SQL twins."""

from __future__ import annotations

import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallybank.functions.risk import risk_bucket, risk_bucket_pandas_udf, risk_bucket_udf
from tallybank.session import session_conf, use_checkpoints
from tallybank.views import Bank

# The settings compared by default.
EXPERIMENT = {
    "aqe off": {"spark.sql.adaptive.enabled": "false"},
    "aqe on": {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "false"},
    "aqe and skew join": {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"},
    "50 partitions": {"spark.sql.shuffle.partitions": "50"},
    "200 partitions": {"spark.sql.shuffle.partitions": "200"},
    "500 partitions": {"spark.sql.shuffle.partitions": "500"},
}


@contextmanager
def timed(name: str, times: dict[str, float] | None = None) -> Iterator[None]:
    """Time a block, which must contain an action: building a DataFrame alone does no work."""
    start = time.perf_counter()
    try:
        yield
    finally:
        seconds = time.perf_counter() - start
        if times is not None:
            times[name] = seconds
        print(f"{name} took {seconds:.3f} s")


def run_fully(df: DataFrame) -> float:
    """Seconds to compute every row and column, without storing them."""
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def plan_report(df: DataFrame) -> dict[str, object]:
    """Shuffles, broadcasts, joins, codegen stages, Python nodes and partition filters of the physical plan.

    Planned with AQE off, so the whole plan is visible before it runs; nodes are told apart by class.
    """
    with session_conf(df.sparkSession, {"spark.sql.adaptive.enabled": "false"}):
        root = df.select("*")._jdf.queryExecution().executedPlan()
    kinds: Counter[str] = Counter()
    filters: list[str] = []
    pending = [root]
    while pending:
        node = pending.pop()
        kind = node.getClass().getSimpleName()
        kinds[kind] += 1
        if kind == "FileSourceScanExec":
            filters += [f.sql() for f in _items(node.partitionFilters())]
        pending += _items(node.children())
    return {
        "shuffles": kinds["ShuffleExchangeExec"],
        "broadcasts": kinds["BroadcastExchangeExec"],
        "joins": {k.removesuffix("Exec"): n for k, n in kinds.items() if "Join" in k or "CartesianProduct" in k},
        "codegen_stages": kinds["WholeStageCodegenExec"],
        "python_nodes": {k.removesuffix("Exec"): n for k, n in kinds.items() if "Python" in k or "Pandas" in k},
        "partition_filters": filters,
    }


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def run_configs(
    spark: SparkSession, build: Callable[[], DataFrame], confs: Mapping[str, Mapping[str, str]] = EXPERIMENT
) -> DataFrame:
    """Run the same query under each setting: seconds, rows, stages, tasks and output partitions."""
    tracker = spark.sparkContext.statusTracker()
    results = []
    for label, conf in confs.items():
        group = f"experiment-{uuid.uuid4().hex}"
        spark.sparkContext.setJobGroup(group, label)
        with session_conf(spark, conf):
            seen = Observation()
            query = build().observe(
                seen, F.count(F.lit(1)).alias("rows"), F.max(F.spark_partition_id()).alias("last_partition")
            )
            seconds = run_fully(query)
        jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(group)]
        stages = [tracker.getStageInfo(stage) for job in jobs if job for stage in job.stageIds]
        ran = [stage for stage in stages if stage and stage.numCompletedTasks]
        last = seen.get["last_partition"]
        partitions = 0 if last is None else last + 1
        tasks = sum(stage.numCompletedTasks for stage in ran)
        results.append((label, seconds, seen.get["rows"], len(ran), tasks, partitions))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return spark.createDataFrame(
        results, "label string, seconds double, row_count bigint, stages int, tasks int, output_partitions int"
    )


def compare_caching(df: DataFrame, actions: Sequence[Callable[[DataFrame], object]]) -> DataFrame:
    """Time the same actions on a frame recomputed each time, cached, kept on disk, and checkpointed."""
    spark = df.sparkSession
    use_checkpoints(spark)
    results = []

    def measure(label: str, prepare: Callable[[], DataFrame], release: Callable[[DataFrame], object]) -> None:
        start = time.perf_counter()
        frame = prepare()
        values = [str(action(frame)) for action in actions]
        results.append((label, time.perf_counter() - start, values))
        release(frame)

    def nothing(_: DataFrame) -> None:
        return None

    def unpersist(frame: DataFrame) -> DataFrame:
        return frame.unpersist(blocking=True)

    measure("none", lambda: df, nothing)
    measure("memory and disk", lambda: df.persist(StorageLevel.MEMORY_AND_DISK), unpersist)
    measure("disk only", lambda: df.persist(StorageLevel.DISK_ONLY), unpersist)
    measure("checkpoint", lambda: df.checkpoint(eager=True), nothing)
    return spark.createDataFrame(results, "strategy string, seconds double, results array<string>")


def compare_udf(df: DataFrame) -> DataFrame:
    """Time the risk bucket in its native and UDF forms, and name the Python nodes in their plans."""
    forms = {
        "native": risk_bucket(),
        "python udf": risk_bucket_udf("transaction_type", "amount"),
        "pandas udf": risk_bucket_pandas_udf("transaction_type", "amount"),
    }
    results = []
    for label, bucket in forms.items():
        query = df.select(bucket.alias("risk_bucket")).groupBy("risk_bucket").count()
        report = plan_report(query)
        results.append((label, run_fully(query), report["codegen_stages"], ",".join(report["python_nodes"])))
    return df.sparkSession.createDataFrame(
        results, "form string, seconds double, codegen_stages int, python_nodes string"
    )


SQL_TWINS = {
    "branch_totals": """
        select a.branch_id, cast(sum(t.amount) as double) as total_amount, sum(t.txn_count) as txn_count
        from (select account_id, sum(cast(amount as decimal(18,2))) as amount, count(*) as txn_count
              from {transaction} group by account_id) t
        join {account} a on a.account_id = t.account_id
        group by a.branch_id
    """,
    "type_currency_totals": """
        select transaction_type, currency, cast(sum(cast(amount as decimal(18,2))) as double) as total_amount,
               count(*) as txn_count
        from {transaction} group by transaction_type, currency
    """,
    "dedup_latest": """
        select * except (newest) from (
          select *, row_number() over (partition by transaction_id order by ingest_date desc, event_ts desc,
            account_id desc, product_id desc, branch_id desc, amount desc, currency desc, transaction_type desc,
            status desc, event_date desc) as newest
          from {transaction}
        ) where newest = 1
    """,
}


def sql_twin(spark: SparkSession, name: str, bank: Bank) -> DataFrame:
    """The SQL form of a DataFrame query, over the same tables."""
    text = SQL_TWINS[name]
    tables = {table: getattr(bank, table) for table in ("transaction", "account") if f"{{{table}}}" in text}
    return spark.sql(text, **tables)


def plan_nodes(df: DataFrame) -> Counter[str]:
    """How often each operator occurs in the optimized plan."""
    text = df._jdf.queryExecution().optimizedPlan().toString()
    names = (line.lstrip(" :+-").split(" ")[0].split("(")[0] for line in text.splitlines())
    return Counter(name for name in names if name)


def compare_plans(left: DataFrame, right: DataFrame) -> tuple[bool, dict[str, tuple[int, int]]]:
    """Whether two queries have the same optimized plan, names and order of equal parts aside, and the operators
    that occur a different number of times in them."""
    plans = [df._jdf.queryExecution().optimizedPlan().canonicalized() for df in (left, right)]
    nodes = [plan_nodes(df) for df in (left, right)]
    differ = {n: (nodes[0][n], nodes[1][n]) for n in sorted(nodes[0] | nodes[1]) if nodes[0][n] != nodes[1][n]}
    return plans[0].equals(plans[1]), differ
