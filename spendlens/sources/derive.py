"""Usage data derived from the given tables, in the shape of the staging tables.

Two domains: `events` (dense activity of one month, every branch of the rules occurs) and `orders`
(seven years of billing lines, for time series and volume).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.sources.tables import COMPRESSION

EVENTS_AS_OF = "2024-01-31"
ORDERS_AS_OF = "2001-11-30"

_IDES = "array('vscode','visualstudio','intellij','eclipse','zed','someeditor')"
_FEATURES = "array('code_completion','agent_edit','copilot_cli','copilot_app','chat_inline','others')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ events domain


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with k (the integer in `props`), d (day), u (login) and o (organisation)."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.col("value").cast("decimal(18,4)").alias("value"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("ts").cast("date").alias("d"),
        F.expr("concat('user', user_id)").alias("u"),
        F.expr("concat('org', user_id % 3)").alias("o"),
    )


def _counts(interactions: str, generations: str, acceptances: str, added="k", deleted="k % 11"):
    return [
        F.expr(e).cast("int").alias(n)
        for e, n in (
            (interactions, "user_initiated_interaction_count"),
            (generations, "code_generation_activity_count"),
            (acceptances, "code_acceptance_activity_count"),
            ("k * 2", "loc_suggested_to_add_sum"),
            ("k % 3", "loc_suggested_to_delete_sum"),
            (added, "loc_added_sum"),
            (deleted, "loc_deleted_sum"),
        )
    ]


_I = "case when user_id % 5 = 0 then 0 else k % 7 end"
_G = "case when user_id % 10 = 0 then 0 else k % 3 end"
_A = f"least({_G}, k % 2)"


def events_premium_requests(ev: DataFrame, blank_product_k: int | None = None) -> DataFrame:
    """Purchases as billing lines. Some logins are spelled in capitals; on request the lines with
    one value of k lose their product."""
    product = "'premium'"
    if blank_product_k is not None:
        product = f"case when k = {blank_product_k} then '' else 'premium' end"
    discount = "case when k % 10 = 0 then cast(value * 0.1 as decimal(18,4)) else 0 end"
    return ev.filter("event_type = 'purchase'").select(
        F.col("d").alias("usage_date"),
        F.expr("case when k % 9 = 0 then upper(u) else u end").alias("user_login"),
        F.col("o").alias("org_login"),
        F.expr(product).alias("product"),
        F.expr("concat('sku', k % 2)").alias("sku"),
        F.expr("concat('model-', k % 4)").alias("model_name"),
        F.lit("request").alias("unit_type"),
        F.expr("cast(0.04 + (k % 3) * 0.000125 as decimal(18,6))").alias("price_per_unit"),
        F.expr("cast(k + 1 as decimal(18,4))").alias("gross_quantity"),
        F.expr("cast(0 as decimal(18,4))").alias("discount_quantity"),
        F.expr("cast(k + 1 as decimal(18,4))").alias("net_quantity"),
        F.col("value").alias("gross_amount"),
        F.expr(discount).cast("decimal(18,4)").alias("discount_amount"),
        F.expr(f"value - {discount}").cast("decimal(18,4)").alias("net_amount"),
    )


def events_user_ide(ev: DataFrame) -> DataFrame:
    """Clicks and views as editor activity, with a few blank editors and unknown users."""
    ide = f"case when k = 97 then '' else element_at({_IDES}, k % 6 + 1) end"
    return ev.filter("event_type in ('click', 'view')").select(
        F.col("d").alias("activity_date"),
        F.expr("case when k = 98 then concat('ghost', user_id) else u end").alias("user_login"),
        F.col("o").alias("org_login"),
        F.expr(ide).alias("ide"),
        F.expr(
            f"case {ide} when 'vscode' then 'VS Code' when 'visualstudio' then 'Visual Studio' "
            "when 'intellij' then 'JetBrains' when 'eclipse' then 'Eclipse' when 'zed' then 'Zed' "
            "else 'Other' end"
        ).alias("ide_family"),
        F.expr("concat('1.', k % 20)").alias("last_known_ide_version"),
        F.expr("case when k % 2 = 0 then concat('0.', k % 5) else '' end").alias(
            "last_known_plugin_version"
        ),
        *_counts(_I, _G, _A),
    )


def events_user_model_feature(ev: DataFrame) -> DataFrame:
    return ev.filter("event_type in ('view', 'error')").select(
        F.col("d").alias("activity_date"),
        F.col("u").alias("user_login"),
        F.col("o").alias("org_login"),
        F.expr("concat('model-', k % 4)").alias("model_name"),
        F.expr(f"element_at({_FEATURES}, k % 6 + 1)").alias("feature"),
        *_counts("k % 3", "k % 5", "k % 2"),
    )


def _known(ev: DataFrame) -> DataFrame:
    """A few users show up in no activity, seat or team record."""
    return ev.filter("user_id % 37 <> 36")


def events_user_day(ev: DataFrame) -> DataFrame:
    return _known(ev).select(
        F.col("d").alias("activity_date"),
        F.col("u").alias("user_login"),
        "user_id",
        F.col("o").alias("org_login"),
        F.expr("cast(user_id % 3 as string)").alias("organization_id"),
        F.lit("1").alias("enterprise_id"),
        F.col("value").alias("ai_credits_used"),
        F.expr("case when user_id % 4 = 0 then 'No Cohort' else concat('Phase ', user_id % 4) end").alias(
            "adoption_phase"
        ),
        F.expr("cast(user_id % 4 as int)").alias("adoption_phase_number"),
        F.expr("k % 2 = 1").alias("used_agent"),
        F.expr("case when event_type = 'view' then true end").alias("used_chat"),
        F.expr("case when event_type = 'click' then k % 5 = 0 end").alias("used_cli"),
        *_counts(_I, _G, _A),
    )


def events_user_teams(ev: DataFrame) -> DataFrame:
    """One membership per user and day, and a second one for every fourth user."""
    days = _known(ev).groupBy("d", "user_id", "u", "o").agg(F.lit(1).alias("one"))
    teams = F.expr(
        "case when user_id % 4 = 0 then array(user_id % 10, 10 + user_id % 3) "
        "else array(user_id % 10) end"
    )
    return days.select(
        F.col("d").alias("activity_date"),
        F.col("u").alias("user_login"),
        "user_id",
        F.col("o").alias("org_login"),
        F.explode(teams).alias("team_id"),
    ).withColumn("team_slug", F.expr("concat('team', team_id)"))


def events_seats(ev: DataFrame) -> DataFrame:
    """One seat per user: some idle for weeks, some never active, some without a team."""
    users = _known(ev).groupBy("user_id", "u", "o").agg(
        F.date_trunc("second", F.max("ts") + F.expr("interval 500 milliseconds"))
        .cast("timestamp_ntz")
        .alias("last")
    )
    return users.select(
        F.col("u").alias("user_login"),
        "user_id",
        F.col("o").alias("org_login"),
        F.expr("case when user_id % 11 = 0 then '' else concat('team', user_id % 7) end").alias(
            "team_name"
        ),
        F.expr("case when user_id % 2 = 0 then 'business' else 'enterprise' end").alias("plan_type"),
        F.expr("timestamp_ntz'2023-12-01 00:00:00'").alias("created_at"),
        F.expr(
            "case when user_id % 8 = 0 then null "
            "when user_id % 4 = 1 then last - interval 40 days else last end"
        ).alias("last_activity_at"),
        F.expr(f"element_at({_IDES}, cast(user_id % 6 as int) + 1)").alias("last_activity_editor"),
        F.lit(None).cast("date").alias("pending_cancellation_date"),
    )


def events_cost_centers(ev: DataFrame) -> DataFrame:
    return (
        ev.filter("user_id % 2 = 0")
        .groupBy("user_id")
        .agg(F.max("u").alias("user_login"))
        .select("user_login", F.expr("concat('cc', user_id % 5)").alias("cost_center"))
    )


def kept(df: DataFrame, path: str | None) -> DataFrame:
    """The rows through a table, so that several readers do not make them anew."""
    if path is None:
        return df
    df.write.mode("overwrite").options(**COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def events_datasets(spark: SparkSession, sf_dir: str, scratch: str | None = None) -> dict[str, DataFrame]:
    """With a scratch folder events are parsed once for all staging tables."""
    ev = kept(events(spark, sf_dir), scratch)
    return {
        "user_day": events_user_day(ev),
        "user_ide": events_user_ide(ev),
        "user_model_feature": events_user_model_feature(ev),
        "user_teams": events_user_teams(ev),
        "premium_requests": events_premium_requests(ev),
        "seats": events_seats(ev),
    }


def events_run_log(ev: DataFrame) -> DataFrame:
    """Every sign-up as a run: a start, and for most of them an end some minutes later."""
    starts = ev.filter("event_type = 'signup'").select(
        F.concat(F.lit("run-"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("run_id"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("started_at"),
        "k",
        "d",
    )
    end = F.col("started_at") + F.expr("make_dt_interval(0, 0, k)")
    steps = F.when(F.col("k") % 7 == 0, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    rows = starts.withColumn("step", F.explode(steps))
    done = F.col("step") == 1
    return rows.select(
        "run_id",
        F.when(done, end + F.expr("interval 1 second")).otherwise(F.col("started_at")).alias("logged_at"),
        "started_at",
        F.when(done, end).alias("completed_at"),
        F.date_sub("d", 7).alias("since_date"),
        F.col("d").alias("until_date"),
        F.expr("case when k % 4 = 0 then 'backfill' else 'timer' end").alias("trigger_source"),
        F.when(~done, "running").when(F.col("k") % 5 == 0, "failed").otherwise("succeeded").alias("status"),
        F.when(done, F.col("k").cast("bigint")).alias("rows_user_day"),
        F.when(done, F.col("k").cast("bigint") * 2).alias("rows_user_ide"),
        F.when(done, F.col("k").cast("bigint") * 3).alias("rows_model_feature"),
        F.when(done, F.col("k").cast("bigint") * 4).alias("rows_premium_requests"),
        F.when(done, F.lit(10).cast("bigint")).alias("rows_seats"),
        F.when(done & (F.col("k") % 5 == 0), "TimeoutError - see the job log for detail").alias("message"),
    )


# ------------------------------------------------------------------ orders domain


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with buyer, part and day; `q` is the quantity as a whole number. Buyers meet the orders,
    which are fewer, so the lines move once for both."""
    line = table(spark, sf_dir, "lineitem")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    bought = order.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return (
        line.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("u"),
            F.expr("concat('nation', c_nationkey)").alias("o"),
            F.col("l_shipdate").cast("date").alias("d"),
            "l_linenumber",
            "l_returnflag",
            "p_brand",
            "p_type",
            F.col("l_quantity").cast("int").alias("q"),
            F.col("l_extendedprice").cast("decimal(18,4)").alias("price"),
            F.col("l_discount").cast("decimal(18,4)").alias("discount"),
        )
    )


def _order_counts():
    return [
        F.expr(e).cast("int").alias(n)
        for e, n in (
            ("case when user_id % 5 = 0 then 0 else q end", "user_initiated_interaction_count"),
            ("case when user_id % 10 = 0 then 0 else l_linenumber end", "code_generation_activity_count"),
            ("case when user_id % 10 = 0 then 0 else l_linenumber % 3 end", "code_acceptance_activity_count"),
            ("q * 2", "loc_suggested_to_add_sum"),
            ("0", "loc_suggested_to_delete_sum"),
            ("q", "loc_added_sum"),
            ("q % 5", "loc_deleted_sum"),
        )
    ]


def orders_datasets(spark: SparkSession, sf_dir: str, scratch: str | None = None) -> dict[str, DataFrame]:
    """With a scratch folder the lines are joined once for all staging tables."""
    lines = kept(order_lines(spark, sf_dir), scratch)
    off = F.expr("cast(price * discount as decimal(18,4))")
    dated = [F.col("d").alias("activity_date"), F.col("u").alias("user_login"), F.col("o").alias("org_login")]
    ide = f"element_at({_IDES}, l_linenumber % 6 + 1)"
    customer = table(spark, sf_dir, "customer")
    return {
        "premium_requests": lines.select(
            F.col("d").alias("usage_date"),
            F.col("u").alias("user_login"),
            F.col("o").alias("org_login"),
            F.col("p_type").alias("product"),
            F.col("l_returnflag").alias("sku"),
            F.col("p_brand").alias("model_name"),
            F.lit("request").alias("unit_type"),
            F.expr("cast(0.04 as decimal(18,6))").alias("price_per_unit"),
            F.col("q").cast("decimal(18,4)").alias("gross_quantity"),
            F.expr("cast(0 as decimal(18,4))").alias("discount_quantity"),
            F.col("q").cast("decimal(18,4)").alias("net_quantity"),
            F.col("price").alias("gross_amount"),
            off.alias("discount_amount"),
            (F.col("price") - off).cast("decimal(18,4)").alias("net_amount"),
        ),
        "user_ide": lines.select(
            *dated,
            F.expr(ide).alias("ide"),
            F.expr(
                f"case {ide} when 'vscode' then 'VS Code' when 'visualstudio' then 'Visual Studio' "
                "when 'intellij' then 'JetBrains' when 'eclipse' then 'Eclipse' "
                "when 'zed' then 'Zed' else 'Other' end"
            ).alias("ide_family"),
            F.lit("1.0").alias("last_known_ide_version"),
            F.lit("").alias("last_known_plugin_version"),
            *_order_counts(),
        ),
        "user_model_feature": lines.select(
            *dated,
            F.col("p_brand").alias("model_name"),
            F.expr(f"element_at({_FEATURES}, q % 6 + 1)").alias("feature"),
            *_order_counts(),
        ),
        "user_day": lines.select(
            *dated, "user_id", F.col("discount").alias("ai_credits_used"),
            F.lit("No Cohort").alias("adoption_phase"), F.lit(0).alias("adoption_phase_number"),
            *_order_counts(),
        ),
        "user_teams": lines.select(*dated, "user_id").distinct().select(  # a team follows from its member
            "*", (F.col("user_id") % 50).alias("team_id"), F.expr("concat('team', user_id % 50)").alias("team_slug")
        ),
        "seats": customer.select(
            F.col("c_name").alias("user_login"),
            F.col("c_custkey").alias("user_id"),
            F.expr("concat('nation', c_nationkey)").alias("org_login"),
            F.col("c_mktsegment").alias("team_name"),
            F.expr("case when c_acctbal > 0 then 'business' else 'enterprise' end").alias("plan_type"),
            F.expr("timestamp_ntz'1995-01-01 00:00:00'").alias("created_at"),
            F.expr("case when c_custkey % 3 = 0 then timestamp_ntz'2001-11-20 12:00:00' end").alias(
                "last_activity_at"
            ),
            F.lit("").alias("last_activity_editor"),
        ),
    }
