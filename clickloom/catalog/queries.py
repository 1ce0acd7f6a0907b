"""Registered queries: every operator run over the tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import text, times
from clickloom.functions.buckets import STEP, VISIT
from clickloom.functions.times import format_action_time
from clickloom.operators import (
    categories,
    distribution,
    pageflow,
    products,
    recon,
    sampling,
    sessions,
    sets,
)
from clickloom.plans.mock_load import load_tables
from clickloom.plans.reconciliation import reconcile_dataset, reconcile_datasets
from clickloom.plans.session_analysis import counted_full_info, session_full_info
from clickloom.session_filter import SessionFilter
from clickloom.sinks import (
    append_result,
    append_result_text,
    read_audit,
    read_files,
    read_report,
    replace_table,
    write_report,
)
from clickloom.sources import generator, layout, warehouse
from clickloom.sources.shared import fresh_folder
from clickloom.sources.tables import ACTION_TABLE, PRODUCT_TABLE, USER_TABLE, fetch, read_ratio_text
from clickloom.streaming import traffic

TASK_ID = "task-1"
BACKLOG_FILES, BACKLOG_BATCH = 8, 3
SEED = 7
DAY = "2024-01-01"
LARGE_SAMPLE = 1500
CHUNK_TERMS = 3
STORE_BUCKETS, STORE_LARGE = 8, 5

# Events that the actions of a kind are made of.
SEARCHES, CLICKS = ("view",), ("click",)
CATEGORY_EVENTS = ("click", "signup", "purchase")

FULL_FILTER = SessionFilter(
    professionals="BUILDING, MACHINERY, HOUSEHOLD",
    cities=", ".join(f"city{n}" for n in range(15)),
    sex="Male",
    keywords="kw0, kw1, kw2, kw3, kw4, kw5",
    category_ids=", ".join(str(n) for n in range(10, 80)),
)

TOP_USERS_SQL = """
select user_id, username, age, professional, city
from {user_info_table} order by age desc, user_id limit 15
"""

# Two states of the whole orders table: the second has other keys for some orders, some
# orders moved onto the next key, and some changed or missing values.
ORDERS_DATASET = {
    "source1_sql": """
        select o_orderkey, o_orderstatus, o_totalprice, o_orderdate from {orders}""",
    "source2_sql": """
        select case when o_orderkey % 97 = 0 then -1 - o_orderkey
                    when o_orderkey % 101 = 0 then o_orderkey + 1
                    else o_orderkey end as o_orderkey,
               case when o_orderkey % 77 <> 0 then o_orderstatus end as o_orderstatus,
               case when o_orderkey % 50 = 0 then o_totalprice + 1
                    else o_totalprice end as o_totalprice,
               o_orderdate
        from {orders}""",
    "identifier": "o_orderkey",
}


def _actions(spark: SparkSession, folder: str, grain: str = "day", kinds: Sequence[str] = ()) -> DataFrame:
    """Actions of the events; ``kinds`` keeps other events out of the scan."""
    events = warehouse.table(spark, folder, "events")
    if kinds:
        events = events.where(F.col("event_type").isin(*kinds))
    return warehouse.actions(events, grain)


def _users(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.users(warehouse.table(spark, folder, "customer"))


def _filtered(spark: SparkSession, folder: str, grain: str = "day") -> DataFrame:
    return sessions.filtered_sessions(_actions(spark, folder, grain), _users(spark, folder))


def _stored_text(df: DataFrame) -> DataFrame:
    """Dates and times as text in the stored format, as the result tables keep them."""
    texts = {
        name: F.col(name).cast("string") if name == "date" else format_action_time(F.col(name))
        for name in ("date", "action_time", "start_time", "end_time")
        if name in df.columns
    }
    return df.withColumns(texts)


def scan_actions(spark: SparkSession, folder: str) -> DataFrame:
    return _stored_text(_actions(spark, folder))


def scan_users(spark: SparkSession, folder: str) -> DataFrame:
    return _users(spark, folder)


def scan_products(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.products(warehouse.table(spark, folder, "part"))


def sql_source(spark: SparkSession, folder: str) -> DataFrame:
    return fetch(spark, [TOP_USERS_SQL], user_info_table=_users(spark, folder))[0]


def action_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.action_kinds(_actions(spark, folder))


def session_actions(spark: SparkSession, folder: str) -> DataFrame:
    steps = sessions.session_actions(_actions(spark, folder))
    return _stored_text(steps.select("session_id", "step", "action_time", "action_id", "page_id"))


def _session_store(spark: SparkSession, folder: str) -> layout.SessionStore:
    """Actions stored by session; those with several actions a day count as large here."""
    name, path = _own_table(spark, "sessions")
    layout.store_by_session(_actions(spark, folder), name, STORE_BUCKETS, STORE_LARGE, path)
    return layout.read_by_session(spark, name)


def session_store_steps(spark: SparkSession, folder: str) -> DataFrame:
    steps = _session_store(spark, folder).steps()
    return _stored_text(steps.select("session_id", "step", "action_time", "action_id", "page_id"))


def session_store_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Summaries with keyword lists from stored actions."""
    store = _session_store(spark, folder)
    lists = store.term_lists("search_keywords")
    return _stored_text(store.summary().join(lists, "session_id", "left"))


def session_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _stored_text(sessions.session_summary(_actions(spark, folder)))


def session_user_check(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.mixed_user_sessions(_actions(spark, folder))


def session_terms(spark: SparkSession, folder: str) -> DataFrame:
    terms = sessions.session_terms(_actions(spark, folder, kinds=SEARCHES + CLICKS))
    return terms.withColumn("first_seen", format_action_time(F.col("first_seen")))


def session_keywords(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.session_term_lists(_actions(spark, folder, kinds=SEARCHES), "search_keywords")


def session_categories(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.session_term_lists(_actions(spark, folder, kinds=CLICKS), "click_categories")


def session_term_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Lists of long sessions, a few terms a row."""
    actions = _actions(spark, folder, "mixed", SEARCHES + CLICKS)
    return sessions.session_term_chunks(actions, size=CHUNK_TERMS)


def session_user_join(spark: SparkSession, folder: str) -> DataFrame:
    summary = sessions.session_summary(_actions(spark, folder))
    return _stored_text(sessions.join_users(summary, _users(spark, folder)))


def session_filter_age(spark: SparkSession, folder: str) -> DataFrame:
    return _stored_text(_filtered(spark, folder))


def session_filter_full(spark: SparkSession, folder: str) -> DataFrame:
    actions, users = _actions(spark, folder, "mixed"), _users(spark, folder)
    return _stored_text(sessions.filtered_sessions(actions, users, FULL_FILTER))


def session_full_info_query(spark: SparkSession, folder: str) -> DataFrame:
    return session_full_info(_actions(spark, folder), _users(spark, folder))


def session_totals(spark: SparkSession, folder: str) -> DataFrame:
    return distribution.session_totals(_filtered(spark, folder))


def session_counters(spark: SparkSession, folder: str) -> DataFrame:
    return distribution.session_counters(_filtered(spark, folder))


def session_info_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Counters that fall off while the full info is written."""
    info, observation = counted_full_info(_actions(spark, folder), _users(spark, folder))
    info.write.format("noop").mode("overwrite").save()
    return distribution.observed_counters(spark, observation)


def visit_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return distribution.histogram(_filtered(spark, folder), VISIT)


def step_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return distribution.histogram(_filtered(spark, folder, "mixed"), STEP)


def visit_length_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return distribution.visit_length_ratio(_filtered(spark, folder), TASK_ID)


def step_length_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return distribution.step_length_ratio(_filtered(spark, folder, "mixed"), TASK_ID)


def category_counts(spark: SparkSession, folder: str) -> DataFrame:
    return categories.category_counts(_actions(spark, folder, kinds=CATEGORY_EVENTS))


def top10_categories(spark: SparkSession, folder: str) -> DataFrame:
    chosen = _filtered(spark, folder)
    return categories.top_categories(_actions(spark, folder, kinds=CATEGORY_EVENTS), chosen, TASK_ID)


def session_sample(spark: SparkSession, folder: str) -> DataFrame:
    return _sample(spark, folder, 100)


def session_sample_large(spark: SparkSession, folder: str) -> DataFrame:
    """Most of the passing sessions."""
    return _sample(spark, folder, LARGE_SAMPLE)


def _sample(spark: SparkSession, folder: str, size: int) -> DataFrame:
    chosen = _filtered(spark, folder)
    return sampling.sample_sessions(chosen, _actions(spark, folder), TASK_ID, size=size, seed=SEED)


def page_conversion(spark: SparkSession, folder: str) -> DataFrame:
    return pageflow.page_conversion(_actions(spark, folder), SessionFilter().page_flow)


def top_products_by_city(spark: SparkSession, folder: str) -> DataFrame:
    clicks = _actions(spark, folder, kinds=CLICKS)
    return products.top_products_by_city(clicks, scan_products(spark, folder))


def _orders_sides(spark: SparkSession, folder: str) -> list[DataFrame]:
    texts = [ORDERS_DATASET["source1_sql"], ORDERS_DATASET["source2_sql"]]
    return fetch(spark, texts, orders=warehouse.table(spark, folder, "orders"))


def _orders_recon(spark: SparkSession, folder: str) -> recon.Reconciliation:
    orders = warehouse.table(spark, folder, "orders")
    return reconcile_dataset(spark, ORDERS_DATASET, orders=orders)


def recon_missing_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_recon(spark, folder).missing_keys


def recon_field_to_field(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_recon(spark, folder).field_to_field


def recon_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_recon(spark, folder).mismatch


def recon_audit(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_recon(spark, folder).audit


def recon_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    lines = warehouse.table(spark, folder, "lineitem")
    return recon.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


def recon_duplicate_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_recon(spark, folder).duplicate_keys


def set_union_all(spark: SparkSession, folder: str) -> DataFrame:
    one, two = _orders_sides(spark, folder)
    return sets.union_all(one, two).select("o_orderkey", "o_orderstatus", "o_totalprice")


def set_except(spark: SparkSession, folder: str) -> DataFrame:
    one, two = _orders_sides(spark, folder)
    return sets.except_distinct(two.select("o_orderkey"), one.select("o_orderkey"))


def set_intersect(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    one, two = _orders_sides(spark, folder)
    return sets.intersect_distinct(one.select(*columns), two.select(*columns))


def gen_actions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions for as many users as the events have."""
    active = warehouse.table(spark, folder, "events").select(F.col("user_id").alias("slot"))
    slots = active.distinct()
    n_users = slots.agg(F.count("*")).scalar()
    return generator.generate_actions(slots, n_users=n_users, seed=SEED, date=DAY)


def gen_users(spark: SparkSession, folder: str) -> DataFrame:
    slots = warehouse.table(spark, folder, "customer").select(F.col("c_custkey").alias("slot"))
    return generator.generate_users(slots, seed=SEED)


def gen_products(spark: SparkSession, folder: str) -> DataFrame:
    slots = warehouse.table(spark, folder, "part").select(F.col("p_partkey").alias("slot"))
    return generator.generate_products(slots, seed=SEED)


def _period_text(df: DataFrame, *others: str) -> DataFrame:
    return df.select(
        F.date_format("period_start", "yyyy-MM-dd HH:mm:ss").alias("period_start"), "clicks", *others
    )


def ad_click_traffic(spark: SparkSession, folder: str) -> DataFrame:
    """As a stream that reads the source to its end."""
    events = warehouse.stream_table(spark, folder, "events")
    return _period_text(traffic.run_traffic(warehouse.actions(events)))


def ad_click_backlog(spark: SparkSession, folder: str) -> DataFrame:
    """As a stream over many files, each with events of all days, a few files a batch."""
    events, path = warehouse.table(spark, folder, "events"), fresh_folder(spark, "backlog")
    events.repartition(BACKLOG_FILES, F.xxhash64("event_id")).write.mode("append").parquet(path)
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", BACKLOG_BATCH).parquet(path)
    return _period_text(traffic.run_traffic(warehouse.actions(source)))


def ad_click_late(spark: SparkSession, folder: str) -> DataFrame:
    """As a stream with a watermark, to which half of the events come after the others."""
    events, path = warehouse.table(spark, folder, "events"), fresh_folder(spark, "late")
    state = fresh_folder(spark, "traffic")
    for half in (0, 1):
        events.where(F.col("event_id") % 2 == half).write.mode("append").parquet(path)
        source = spark.readStream.schema(events.schema).parquet(path)
        query = traffic.start_traffic(warehouse.actions(source), state, watermark="1 hour")
        query.awaitTermination()
    return _period_text(traffic.read_traffic(spark, state), "late_deliveries")


def ad_clicks_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """The same transformation on a batch: all days."""
    return _period_text(traffic.clicks_per_period(_actions(spark, folder, kinds=CLICKS)))


def time_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Stored times of sessions as text, compared and taken apart."""
    stored = _stored_text(sessions.session_summary(_actions(spark, folder)))
    parts = times.time_parts(F.col("end_time"))
    return stored.select(
        "session_id",
        times.time_earlier(F.col("start_time"), F.col("end_time")).alias("takes_time"),
        F.concat_ws("/", *[parts[n] for n in range(3)]).alias("end_day"),
        F.concat_ws(":", text.pad_two(parts[3]), parts[4], parts[5]).alias("end_clock"),
    )


def packed_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Fields of sessions read back from the old packed text."""
    summary = sessions.session_summary(_actions(spark, folder))
    fields = ("session_id", "visit_length", "step_length")
    pairs = [F.concat(F.lit(f"{name}="), F.col(name).cast("string")) for name in fields]
    packed = summary.select(F.concat_ws("|", *pairs).alias("packed"))
    return packed.select(
        "packed",
        *[text.packed_field(F.col("packed"), name).alias(name) for name in fields],
        text.packed_field(F.col("packed"), "age").alias("age"),
    )


def counters_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """Counters that went through their JSON text."""
    stored = distribution.counters_json(distribution.session_counters(_filtered(spark, folder)))
    return stored.select(F.explode(text.decode_counts(F.col("counters"))).alias("counter", "sessions"))


def _own_table(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """A table name that nothing else uses, and its folder."""
    path = fresh_folder(spark, purpose)
    return path.rsplit("/", 1)[1].replace("-", "_"), f"{path}/table"


def _stored(spark: SparkSession, name: str) -> DataFrame:
    """Rows of a table from its files; the table itself leaves the catalog."""
    stored = read_files(spark, name)
    spark.sql(f"drop table {name}")
    return stored


def sink_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Users stored three times; each time replaces the one before, once with other columns."""
    name, path = _own_table(spark, "replace")
    users = _users(spark, folder)
    replace_table(users.where("age < 30").drop("city"), name, path=path)
    replace_table(users.where("age < 40"), name, path=path)
    replace_table(users, name, "sex", path)
    return _stored(spark, name).select(*users.columns)


def sink_append(spark: SparkSession, folder: str) -> DataFrame:
    """Ratios of two tasks in one table, one of them run twice."""
    name, path = _own_table(spark, "append")
    passing = _filtered(spark, folder)
    for task in (TASK_ID, "task-2", TASK_ID):
        append_result(distribution.visit_length_ratio(passing, task), name, path)
    return _stored(spark, name)


def sink_ratio_text(spark: SparkSession, folder: str) -> DataFrame:
    """The same in the text layout of the recorded results, read back."""
    path = fresh_folder(spark, "ratio-text")
    passing = _filtered(spark, folder)
    for task in (TASK_ID, "task-2", TASK_ID):
        append_result_text(distribution.visit_length_ratio(passing, task), path)
    return read_ratio_text(spark, path, VISIT.ratio_columns())


def _report(spark: SparkSession, folder: str) -> str:
    """Folder of a report on two datasets."""
    swapped = {
        "source1_sql": ORDERS_DATASET["source2_sql"],
        "source2_sql": ORDERS_DATASET["source1_sql"],
        "identifier": ORDERS_DATASET["identifier"],
    }
    orders = warehouse.table(spark, folder, "orders")
    datasets = {"orders": ORDERS_DATASET, "swapped": swapped}
    path = fresh_folder(spark, "report")
    write_report(reconcile_datasets(spark, {"datasets": datasets}, orders=orders), path)
    return path


def sink_report(spark: SparkSession, folder: str) -> DataFrame:
    """Audits of two datasets from the stored report."""
    return read_audit(spark, _report(spark, folder))


def sink_report_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All other tables of the stored report, their rows as text."""
    path = _report(spark, folder)
    key, sides = "o_orderkey", recon.SIDES
    columns = {
        "missing_keys": ["missing_from", key],
        "duplicate_keys": [key, *[f"rows_{side}" for side in sides]],
        "field_to_field": [f"{c}_{side}" for c in (key, "o_orderstatus", "o_orderdate") for side in sides],
    }
    parts = [
        read_report(spark, path, table, dataset).select(
            F.lit(dataset).alias("dataset"),
            F.lit(table).alias("report"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in names]).alias("row"),
        )
        for dataset in ("orders", "swapped")
        for table, names in columns.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def load_generated(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the three generated tables after they have been stored."""
    generated = {
        ACTION_TABLE: gen_actions(spark, folder),
        USER_TABLE: gen_users(spark, folder),
        PRODUCT_TABLE: gen_products(spark, folder),
    }
    path = fresh_folder(spark, "load")
    prefix = path.rsplit("/", 1)[1].replace("-", "_") + "_"
    load_tables(generated, path, prefix)
    counts = [
        _stored(spark, prefix + name).agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        for name in generated
    ]
    return reduce(DataFrame.unionAll, counts)


def gen_today(spark: SparkSession, folder: str) -> DataFrame:
    """Actions generated for the current day: all of them, and those of another day."""
    slots = warehouse.table(spark, folder, "events").select(F.col("user_id").alias("slot")).distinct()
    actions = generator.generate_actions(slots, seed=SEED)
    today = F.col("date") == F.current_date().cast("string")
    return actions.agg(F.count("*").alias("actions"), F.count_if(~today).alias("of_other_days"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {"session_full_info": session_full_info_query}
    plain = [
        scan_actions,
        scan_users,
        scan_products,
        sql_source,
        action_kinds,
        session_actions,
        session_store_steps,
        session_store_summary,
        session_summary,
        session_user_check,
        session_terms,
        session_keywords,
        session_categories,
        session_term_chunks,
        session_user_join,
        session_filter_age,
        session_filter_full,
        session_totals,
        session_counters,
        session_info_counters,
        visit_histogram,
        step_histogram,
        visit_length_ratio,
        step_length_ratio,
        category_counts,
        top10_categories,
        session_sample,
        session_sample_large,
        page_conversion,
        recon_missing_keys,
        recon_field_to_field,
        recon_mismatch,
        recon_audit,
        recon_duplicates,
        recon_duplicate_pairs,
        set_union_all,
        set_except,
        set_intersect,
        gen_actions,
        gen_users,
        gen_products,
        top_products_by_city,
        ad_click_traffic,
        ad_click_backlog,
        ad_click_late,
        ad_clicks_by_day,
        time_texts,
        packed_summary,
        counters_decoded,
        sink_replace,
        sink_append,
        sink_ratio_text,
        sink_report,
        sink_report_rows,
        load_generated,
        gen_today,
    ]
    return {**{query.__name__: query for query in plain}, **named}
