"""A user's report passes over the row groups that do not hold the user."""

from pyspark.sql import functions as F

from spendlens.schemas import FACTS
from spendlens.sources.tables import USER_FILTER, Warehouse


def _scanned_rows(df):
    """Rows that the scans of an executed query put out, by their own metrics."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()

    def walk(node):
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            return node.metrics().apply("numOutputRows").value()
        children = node.children()
        return sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(plan.finalPhysicalPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)


def test_a_user_is_found_without_reading_other_row_groups(spark, tmp_path):
    """Two hundred files of a month, every one with users from a to z; one user is in three of them."""
    wh = Warehouse(spark, str(tmp_path / "wh"), "month")
    rows = spark.range(40_000).select(
        (F.lit(20260801) + F.col("id") % 28).cast("int").alias("date_key"),
        F.substring(F.md5(F.col("id").cast("string")), 1, 12).alias("user_key"),
        F.lit("o").alias("org_key"), F.lit("vim").alias("editor_key"),
    )
    rare = spark.range(3).select(
        (F.lit(20260801) + F.col("id") * 9).cast("int").alias("date_key"), F.lit("8rare").alias("user_key"),
        F.lit("o").alias("org_key"), F.lit("vim").alias("editor_key"),
    )
    names = [f.name for f in FACTS["fact_user_ide_day"].fields]
    both = rows.union(rare)
    both = both.select(*(F.col(n) if n in both.columns else
                         F.lit(None).cast(FACTS["fact_user_ide_day"][n].dataType).alias(n) for n in names))
    # files that overlap in users: dealt by hash, as many small loads leave them
    spread = both.repartition(200, F.xxhash64("user_key", "date_key"))
    path = f"{wh.root}/spread"
    spread.sortWithinPartitions("user_key").write.options(**USER_FILTER).parquet(path)
    plain = f"{wh.root}/plain"
    spread.sortWithinPartitions("user_key").write.parquet(plain)

    def of(path):
        return spark.read.parquet(path).filter("user_key = '8rare'")

    assert of(path).count() == of(plain).count() == 3
    assert _scanned_rows(of(plain)) > 30_000  # least and greatest user of a file tell nothing
    assert _scanned_rows(of(path)) < 3_000


def test_stored_facts_carry_the_filter(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    users = spark.range(2_000).select(F.format_string("u%05d", "id").alias("user_key"))
    names = FACTS["fact_user_team_day"].names
    rows = users.select(
        F.lit(20260801).alias("date_key"), "user_key", F.lit("t").alias("team_key"),
        F.lit(None).cast("timestamp_ntz").alias("loaded_at"),
    ).select(*names)
    wh.write_run("r", "fact_user_team_day", rows)
    stored = wh.read_run("r", "fact_user_team_day")
    assert _scanned_rows(stored.filter("user_key = 'u00500'")) > 0
    assert _scanned_rows(stored.filter("user_key = 'u00500x'")) == 0  # within the range, and in no file
