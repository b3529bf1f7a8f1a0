"""

Decimals are published as DOUBLE and dates as text, so that both engines return the same types.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_queries import ORACLES
from perennia.functions.money import parse_amount
from perennia.functions.tags import explode_tags
from perennia.functions.weeks import POLICIES, week_of
from perennia.operators.dispositions import event_dispositions, rejects
from perennia.operators.fold import Entities, entities, entities_of, entities_of_state, fold
from perennia.operators.rank import dense_rank_x, top_x
from perennia.plans import reports
from perennia.plans.ingest import ingest, ingest_more, read_stored, stored_entities
from perennia.plans.ltv import customer_metrics, ltv, ltv_timeframe, result_columns, score
from perennia.plans.ltv_sql import ltv_sql
from perennia.plans.ltv_touch import touch_ltv, touch_profiles
from perennia.plans.store import store_entities, store_rejects, upsert
from perennia.plans.value_store import refresh_value, stored_top, stored_values
from perennia.schema import ALL_TYPES, CUSTOMER, FACT_FIELDS, LTV_FIELDS, ORDER, SITE_VISIT
from perennia.session import configure, work_folder
from perennia.sinks import result_document
from perennia.sources.array_scan import read_event_arrays
from perennia.sources.event_log import read_event_log, union_logs, write_event_log
from perennia.sources.inline import inline_relation
from perennia.sources.json_events import from_json_lines, read_event_lines, read_events, stream_events, to_json_lines
from perennia.sources.tables import entities_from_tables, event_log_from_tables, relations_from_orders
from perennia.streaming import jobs
from perennia.streaming.compaction import compact, remove_merged

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _log(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    return event_log_from_tables(_table(spark, sf_dir, "events"), types or None)


def _entities(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = LTV_FIELDS) -> Entities:
    return entities_from_tables(_table(spark, sf_dir, "events"), columns=columns)


def _log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _table(spark, sf_dir, "events").schema
    # Written as a pattern, the path may be one file or a folder of files.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return event_log_from_tables(stream)


def _sales(spark: SparkSession, sf_dir: str):
    """(customer, site_visit, orders) relations of the order tables."""
    tables = (_table(spark, sf_dir, t) for t in ("customer", "nation", "orders"))
    return relations_from_orders(*tables)


def published(rows: DataFrame) -> DataFrame:
    """Decimals as DOUBLE, dates as text, integers as BIGINT."""
    out = []
    for field in rows.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.IntegerType):
            c = c.cast("bigint")
        out.append(c.alias(field.name))
    return rows.select(*out)


# --- lifetime value ---------------------------------------------------------------------------


def ltv_fold_all(spark, sf_dir):
    return result_columns(ltv(_entities(spark, sf_dir)))


def ltv_fold_top10(spark, sf_dir):
    return result_columns(top_x(ltv(_entities(spark, sf_dir)), 10))


def ltv_fold_dense_rank_top10(spark, sf_dir):
    ranked = dense_rank_x(ltv(_entities(spark, sf_dir)), 10)
    return ranked.select("customer_id", "ltv", "rank")


def _sql_relations(spark, sf_dir):
    """Customers of the customer table, visits and orders of the event log (bad times are no week)."""
    current = _entities(spark, sf_dir)
    people = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("last_name"),
        F.col("c_nationkey").cast("string").alias("adr_city"),
        F.col("c_mktsegment").alias("adr_state"),
    )
    return people, current.site_visit, current.orders


def ltv_sql_all(spark, sf_dir):
    return ltv_sql(*_sql_relations(spark, sf_dir))


def ltv_sql_rank_all(spark, sf_dir):
    return ltv_sql(*_sql_relations(spark, sf_dir), ranked=True)


def ltv_sql_dense_rank_top10(spark, sf_dir):
    return ltv_sql(*_sql_relations(spark, sf_dir), k=10)


def ltv_sql_customer_events_top10(spark, sf_dir):
    """Customer rows straight from the log, as raw events: repeated ids fan out."""
    people = _log(spark, sf_dir, CUSTOMER).withColumn("customer_id", F.col("key"))
    current = _entities(spark, sf_dir)
    return ltv_sql(people, current.site_visit, current.orders, k=10)


def ltv_touch_all(spark, sf_dir):
    return touch_ltv(_log(spark, sf_dir, *ALL_TYPES)).select("customer_id", "visits", "weeks", "ltv")


def ltv_touch_top10(spark, sf_dir):
    return top_x(touch_ltv(_log(spark, sf_dir, *ALL_TYPES)), 10).select("customer_id", "ltv")


def touch_customer_profiles(spark, sf_dir):
    return touch_profiles(_log(spark, sf_dir, *ALL_TYPES)).drop("profile_seq")


def ltv_timeframe_all(spark, sf_dir):
    return result_columns(ltv_timeframe(_entities(spark, sf_dir)))


def _cross_year(policy):
    def query(spark, sf_dir):
        return result_columns(ltv(entities_of(*_sales(spark, sf_dir)), policy))

    return query


def _bad_time(policy):
    def query(spark, sf_dir):
        log = _log(spark, sf_dir, SITE_VISIT, ORDER)
        metrics = customer_metrics(fold(log, (SITE_VISIT, ORDER), policy, LTV_FIELDS))
        return score(metrics).select("customer_id", "visits", "weeks", "visits_per_week")

    return query


# --- entities, dispositions, reports ----------------------------------------------------------


def customer_current(spark, sf_dir):
    return _entities(spark, sf_dir).customer


def order_current(spark, sf_dir):
    return _entities(spark, sf_dir).orders.select("order_id", "customer_id", "amount", "first_seq", "last_seq")


def site_visit_current(spark, sf_dir):
    return _entities(spark, sf_dir, FACT_FIELDS).site_visit.select("page_id", "customer_id", "event_date", "tags")


def image_current(spark, sf_dir):
    return _entities(spark, sf_dir, FACT_FIELDS).image.select("image_id", "customer_id", "camera_make", "camera_model")


def dispositions(spark, sf_dir):
    return event_dispositions(_log(spark, sf_dir)).select("seq", "type", "verb", "key", "disposition")


def dispositions_skip_bad_time(spark, sf_dir):
    return reports.disposition_counts(_log(spark, sf_dir), "skip")


def rejects_by_reason(spark, sf_dir):
    return reports.rejects_by_reason(_log(spark, sf_dir))


def rejected_events(spark, sf_dir):
    return rejects(_log(spark, sf_dir)).select("reason", "type", "key", "seq")


def ingest_summary(spark, sf_dir):
    return reports.ingest_summary(_log(spark, sf_dir))


def events_by_type_verb(spark, sf_dir):
    return reports.events_by_type_verb(_log(spark, sf_dir))


def weekly_visit_histogram(spark, sf_dir):
    facts = fold(_log(spark, sf_dir, SITE_VISIT), (SITE_VISIT,), columns=LTV_FIELDS)
    return reports.weekly_visit_histogram(facts).withColumn("week", F.coalesce("week", F.lit(-1)))


def visit_week_map(spark, sf_dir):
    """The map printed as text `week:visits,...`."""
    weeks = reports.visit_week_map(fold(_log(spark, sf_dir, SITE_VISIT), (SITE_VISIT,), columns=LTV_FIELDS))
    entries = F.transform(
        F.map_entries("weeks"), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), e["value"].cast("string"))
    )
    return weeks.select("customer_id", F.array_join(entries, ",").alias("weeks"))


def visits_per_customer(spark, sf_dir):
    return reports.visits_per_customer(fold(_log(spark, sf_dir, SITE_VISIT), (SITE_VISIT,), columns=LTV_FIELDS))


def revenue_per_customer(spark, sf_dir):
    return reports.revenue_per_customer(fold(_log(spark, sf_dir, ORDER), (ORDER,), columns=LTV_FIELDS))


def visits_per_week(spark, sf_dir):
    return ltv(_entities(spark, sf_dir)).select("customer_id", "visits", "weeks", "visits_per_week")


def revenue_per_visit(spark, sf_dir):
    return ltv(_entities(spark, sf_dir)).select("customer_id", "revenue", "visits", "revenue_per_visit")


def orphan_facts(spark, sf_dir):
    return reports.orphan_facts(_entities(spark, sf_dir))


def orphan_facts_of_segment(spark, sf_dir):
    """Facts of the log whose customer is not in the BUILDING segment of the customer table."""
    people = _table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("customer_id"))
    return reports.orphan_facts(_entities(spark, sf_dir)._replace(customer=people))


def customers_without_visits(spark, sf_dir):
    """Customers of the customer table that the log never saw visit."""
    people = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    current = _entities(spark, sf_dir)._replace(customer=people)
    return reports.customers_without_visits(current)


def top_per_segment(spark, sf_dir):
    scored = ltv(entities_of(*_sales(spark, sf_dir)))
    return reports.top_per_segment(scored, "adr_state", 5).select(
        F.col("adr_state").alias("segment"), "position", "customer_id", "ltv"
    )


def ltv_rollup_region(spark, sf_dir):
    scored = ltv(entities_of(*_sales(spark, sf_dir))).select(F.col("adr_city").alias("nation"), "ltv")
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("nation"), F.col("r_name").alias("region")
    )
    # A customer without a nation counts in the totals, under no place.
    return reports.ltv_by_place(scored.join(places, "nation", "left"), "region", "nation")


def tags_normalised(spark, sf_dir):
    visits = _log(spark, sf_dir, SITE_VISIT)
    return explode_tags(visits.select("seq", "tags"), "seq")


def week_functions(spark, sf_dir):
    """Orders per day with the three weeks of that day."""
    day = F.col("o_orderdate").cast("date")
    daily = _table(spark, sf_dir, "orders").groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    return daily.select("day", "orders", *[week_of(F.col("day"), p).alias(p) for p in POLICIES])


def parsed_amounts(spark, sf_dir):
    """Readable and junk amounts of the purchase events."""
    sales = _log(spark, sf_dir, ORDER)
    amount = parse_amount(F.col("total_amount"))
    return sales.groupBy("verb").agg(
        F.count(amount).alias("readable"),
        F.count_if(amount.isNull()).alias("junk"),
        F.sum(amount).alias("total"),
    )


def json_round_trip(spark, sf_dir):
    """The log turned into JSON texts and parsed back, then folded."""
    parsed = from_json_lines(to_json_lines(_timed(spark, sf_dir), "seq"))
    return result_columns(ltv(entities(parsed, columns=LTV_FIELDS)))


def union_of_logs(spark, sf_dir):
    """The event log together with a log of the order tables that lacks most of its fields."""
    people, visits, sales = _sales(spark, sf_dir)
    bought = sales.select(
        F.lit(ORDER).alias("type"), F.lit("NEW").alias("verb"), (F.col("key") + 1_000_000_000).alias("key"),
        "customer_id", "event_date", "amount", (F.col("key") + 1_000_000_000).alias("seq"),
        F.lit("0 USD").alias("total_amount"),
    )
    both = union_logs(_log(spark, sf_dir, ORDER), bought)
    return reports.revenue_per_customer(fold(both, (ORDER,), columns=LTV_FIELDS))


def result_document_top10(spark, sf_dir):
    """The ten highest customers as one JSON document."""
    return result_document(ltv(_entities(spark, sf_dir)), 10)


def _ingested(spark, sf_dir):
    """Run the ingest job over the whole log; returns the folder of its tables."""
    folder = work_folder(spark, "ingest")
    ingest(_log(spark, sf_dir), folder)
    return folder


def ingested_ltv(spark, sf_dir):
    return result_columns(ltv(stored_entities(spark, _ingested(spark, sf_dir))))


def ingested_rejects(spark, sf_dir):
    stored = read_stored(spark, _ingested(spark, sf_dir), "rejects")
    return stored.select("reason", "type", "key", "seq")


def ingested_twice_ltv(spark, sf_dir):
    """One half of the log stored, then the other added."""
    folder = work_folder(spark, "ingest")
    log = _log(spark, sf_dir)
    ingest(log.where("seq % 2 = 0"), folder)
    ingest_more(log.where("seq % 2 = 1"), folder)
    return result_columns(ltv(stored_entities(spark, folder)))


def _upserted(spark, sf_dir):
    """The log added to a store in three parts, none of which is earlier than the others."""
    folder = work_folder(spark, "store")
    for part in (2, 0, 1):
        upsert(_log(spark, sf_dir).where(f"seq % 3 = {part}"), folder, buckets=8)
    return folder


def upserted_ltv(spark, sf_dir):
    return result_columns(ltv(store_entities(spark, _upserted(spark, sf_dir))))


def upserted_rejects(spark, sf_dir):
    return store_rejects(spark, _upserted(spark, sf_dir)).select("reason", "type", "key", "seq")


def _valued(spark, sf_dir, week_policy="sunday_u"):
    """Values of a store that takes the log in two parts, neither of them earlier, and is valued after each."""
    folder = work_folder(spark, "values")
    for part in (1, 0):
        upsert(_log(spark, sf_dir).where(f"seq % 2 = {part}"), f"{folder}/events", buckets=8)
        refresh_value(spark, f"{folder}/events", f"{folder}/values", week_policy, buckets=4)
    return f"{folder}/values"


def value_store_ltv(spark, sf_dir):
    return result_columns(stored_values(spark, _valued(spark, sf_dir)))


def value_store_calendar_ltv(spark, sf_dir):
    """Calendar weeks, counted from stored sums."""
    values = stored_values(spark, _valued(spark, sf_dir, "sunday_calendar"))
    return values.select("customer_id", "visits", "weeks", "visits_per_week", "ltv")


def ingested_customers_only(spark, sf_dir):
    """A store that has no facts."""
    folder = work_folder(spark, "ingest")
    ingest(_log(spark, sf_dir, CUSTOMER), folder)
    return result_columns(ltv(stored_entities(spark, folder)))


def _timed(spark, sf_dir):
    """The log with its time as text, as JSON holds it: in the order of the events, some unreadable."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    unreadable = F.when(F.col("event_date").isNull(), F.lit(" or so")).otherwise(F.lit(""))
    return _log(spark, sf_dir).withColumn("event_time", F.concat(text, unreadable))


def _json_files(spark, sf_dir, array):
    """The whole log below the shared folder: lines, or an array of elements on own lines per (key, part)."""
    folder = work_folder(spark, "json")
    lines = to_json_lines(_timed(spark, sf_dir), "seq")
    if array:
        # Each file is one array; events of one file are spread over several lines of it.
        part = lines.groupBy(F.expr("seq div 5000").alias("part")).agg(F.array_sort(F.collect_list(F.struct("seq", "value"))).alias("rows"))
        lines = part.select(F.concat(F.lit("["), F.array_join(F.transform("rows", lambda r: r["value"]), ",\n"), F.lit("\n]")).alias("value"))
        lines.write.option("maxRecordsPerFile", 1).text(folder)
    else:
        lines.select("value").write.text(folder)
    return folder


def json_array_ltv(spark, sf_dir):
    """Written as files that hold arrays over several lines, read whole, folded."""
    return result_columns(ltv(entities(read_events(spark, _json_files(spark, sf_dir, True)), columns=LTV_FIELDS)))


def json_array_lines_ltv(spark, sf_dir):
    """The same files read line by line, which splits them."""
    return result_columns(ltv(entities(read_event_lines(spark, _json_files(spark, sf_dir, True)), columns=LTV_FIELDS)))


def _array_files(spark, sf_dir, extra=""):
    """The whole log as files of one array on one line each, `extra` standing in the middle of each."""
    folder = work_folder(spark, "arrays")
    rows = to_json_lines(_timed(spark, sf_dir), "seq").groupBy(F.expr("seq div 2000").alias("part"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("seq", "value"))), lambda r: r["value"])
    half = F.floor(F.size("texts") / 2).cast("int")
    with_extra = F.concat(F.slice("texts", F.lit(1), half), F.array(F.lit(extra)), F.slice("texts", half + 1, F.size("texts")))
    array = F.array_join(with_extra if extra else F.col("texts"), ", ")
    whole = rows.agg(texts.alias("texts")).select(F.concat(F.lit("["), array, F.lit("]")).alias("value"))
    whole.write.option("maxRecordsPerFile", 1).text(folder)
    return folder


def json_split_arrays_ltv(spark, sf_dir):
    """Arrays on one line each, read by byte ranges."""
    return result_columns(ltv(entities(read_event_arrays(spark, _array_files(spark, sf_dir)), columns=LTV_FIELDS)))


def json_salvaged_rejects(spark, sf_dir):
    """One element of each array is no event; the others count."""
    return reports.rejects_by_reason(read_event_arrays(spark, _array_files(spark, sf_dir, '{"type": }')))


def json_with_empty_folder_ltv(spark, sf_dir):
    """Array files, and beside them a folder that holds none."""
    empty = work_folder(spark, "empty")
    to_json_lines(_log(spark, sf_dir).where("false")).write.text(empty)
    return result_columns(ltv(entities(read_events(spark, [_json_files(spark, sf_dir, True), empty]), columns=LTV_FIELDS)))


def json_missing_fields(spark, sf_dir):
    """Rejects of a log whose events lack a required field here and there."""
    lacking = {"type": 37, "event_time": 31, "key": 23, "customer_id": 29, "verb": 41, "total_amount": 43}
    log = _timed(spark, sf_dir)
    holes = log.withColumns({name: F.when(F.col("seq") % n != 0, F.col(name)) for name, n in lacking.items()})
    folder = work_folder(spark, "json")
    to_json_lines(holes, "seq").select("value").write.text(folder)
    return reports.rejects_by_reason(read_event_lines(spark, folder)).where("reason like 'MISSING%'")


def events_by_inline_kind(spark, sf_dir):
    """Events per kind, the kinds being a relation stated as rows, and all of them."""
    kinds = [(CUSTOMER, "person"), (SITE_VISIT, "page"), ("IMAGE", "picture"), (ORDER, "sale")]
    log = _log(spark, sf_dir)
    named = log.join(inline_relation(spark, kinds, "type string, kind string"), "type")
    counts = named.groupBy("kind").agg(F.count(F.lit(1)).alias("events"))
    return union_logs(counts, log.agg(F.lit("all").alias("kind"), F.count(F.lit(1)).alias("events")))


def json_lines_ltv(spark, sf_dir):
    return result_columns(ltv(entities(read_event_lines(spark, _json_files(spark, sf_dir, False)), columns=LTV_FIELDS)))


def stream_json_ltv(spark, sf_dir):
    """Array files as they arrive, kept as mergeable state."""
    base = work_folder(spark, "streamed")
    stream = stream_events(spark, _json_files(spark, sf_dir, True))
    jobs.stream_partials(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return result_columns(ltv(entities_of_state(jobs.read_state(spark, f"{base}/out"))))


def json_array_rejects(spark, sf_dir):
    """Rejects by reason of array files, one of them with something behind its array."""
    folder = _json_files(spark, sf_dir, True)
    _log(spark, sf_dir).agg(F.concat(F.lit("[] "), F.max("seq").cast("string"))).write.mode("append").text(folder)
    return reports.rejects_by_reason(read_events(spark, folder))


def event_log_by_type_verb(spark, sf_dir):
    """Written as the partitioned log and read back."""
    folder = work_folder(spark, "log")
    write_event_log(_log(spark, sf_dir), folder)
    return reports.events_by_type_verb(read_event_log(spark, folder))


# --- streaming --------------------------------------------------------------------------------


def _run_stream(spark, sf_dir, purpose, start):
    """Run a streaming job over the whole log until it has seen everything; returns its folder."""
    base = work_folder(spark, purpose)
    start(_log_stream(spark, sf_dir), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return f"{base}/out"


def stream_state_equals_batch(spark, sf_dir):
    out = _run_stream(spark, sf_dir, "state", jobs.stream_state)
    state = jobs.read_state(spark, out)
    return state.select("type", "key", "customer_id", "amount", "first_seq", "last_seq")


def stream_partials_ltv(spark, sf_dir):
    out = _run_stream(spark, sf_dir, "partials", jobs.stream_partials)
    return result_columns(ltv(entities_of_state(jobs.read_state(spark, out))))


def stream_compacted_ltv(spark, sf_dir):
    """The log as several batches, merged when they are there, and what was merged removed."""
    base = work_folder(spark, "compacted")
    events = _table(spark, sf_dir, "events")
    events.repartition(7, "event_id").write.parquet(f"{base}/in")
    files = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    log = event_log_from_tables(files)
    jobs.stream_partials(log, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    compact(spark, f"{base}/out", fan=2)
    remove_merged(spark, f"{base}/out", keep=1)
    return result_columns(ltv(entities_of_state(jobs.read_state(spark, f"{base}/out"))))


def stream_ltv_top10(spark, sf_dir):
    out = _run_stream(spark, sf_dir, "top", lambda *a: jobs.stream_top(*a, x=10))
    return jobs.read_top(spark, out)


def _streamed_store(spark, sf_dir):
    """The log as two batches to a store and its values."""
    base = work_folder(spark, "stored")
    events = _table(spark, sf_dir, "events")
    events.repartition(2, "event_id").write.parquet(f"{base}/in")
    files = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    log = event_log_from_tables(files)
    jobs.stream_store(log, f"{base}/out", f"{base}/checkpoint", buckets=4).awaitTermination()
    return f"{base}/out"


def stream_store_top10(spark, sf_dir):
    return result_columns(stored_top(spark, f"{_streamed_store(spark, sf_dir)}/values", 10))


def stream_store_rejects(spark, sf_dir):
    rows = store_rejects(spark, f"{_streamed_store(spark, sf_dir)}/events")
    return rows.select("reason", "type", "key", "seq")


def stream_weekly_visits(spark, sf_dir):
    out = _run_stream(spark, sf_dir, "weekly", jobs.stream_weekly_visits)
    return jobs.read_weekly_visits(spark, out)


def stream_late_visits(spark, sf_dir):
    """Weekly visits when the earlier half of the events comes last, to a job that had finished."""
    base = work_folder(spark, "late")
    events = _table(spark, sf_dir, "events")
    half = events.agg(F.percentile_approx("event_id", 0.5)).scalar()
    for part in (F.col("event_id") > half, F.col("event_id") <= half):
        events.where(part).write.mode("append").parquet(f"{base}/in")
        log = event_log_from_tables(spark.readStream.schema(events.schema).parquet(f"{base}/in"))
        jobs.stream_weekly_visits(log, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return jobs.read_weekly_visits(spark, f"{base}/out")


def stream_first_seen(spark, sf_dir):
    out = _run_stream(spark, sf_dir, "first", jobs.stream_first_seen)
    return spark.read.parquet(out).select("type", "key")


def stream_ingested_log(spark, sf_dir):
    out = _run_stream(spark, sf_dir, "log", jobs.stream_to_log)
    return reports.events_by_type_verb(spark.read.parquet(out))


_QUERIES: dict[str, Query] = {
    "ltv_fold_all": ltv_fold_all,
    "ltv_fold_top10": ltv_fold_top10,
    "ltv_fold_dense_rank_top10": ltv_fold_dense_rank_top10,
    "ltv_sql_all": ltv_sql_all,
    "ltv_sql_rank_all": ltv_sql_rank_all,
    "ltv_sql_dense_rank_top10": ltv_sql_dense_rank_top10,
    "ltv_sql_customer_events_top10": ltv_sql_customer_events_top10,
    "ltv_touch_all": ltv_touch_all,
    "ltv_touch_top10": ltv_touch_top10,
    "touch_customer_profiles": touch_customer_profiles,
    "ltv_timeframe": ltv_timeframe_all,
    "ltv_cross_year_u": _cross_year("sunday_u"),
    "ltv_cross_year_iso": _cross_year("iso"),
    "ltv_cross_year_calendar": _cross_year("sunday_calendar"),
    "bad_time_null_week": _bad_time("null_week"),
    "bad_time_skip": _bad_time("skip"),
    "customer_current": customer_current,
    "order_current": order_current,
    "site_visit_current": site_visit_current,
    "image_current": image_current,
    "event_dispositions": dispositions,
    "dispositions_skip_bad_time": dispositions_skip_bad_time,
    "rejects_by_reason": rejects_by_reason,
    "rejected_events": rejected_events,
    "ingest_summary": ingest_summary,
    "events_by_type_verb": events_by_type_verb,
    "weekly_visit_histogram": weekly_visit_histogram,
    "visit_week_map": visit_week_map,
    "visits_per_customer": visits_per_customer,
    "revenue_per_customer": revenue_per_customer,
    "visits_per_week": visits_per_week,
    "revenue_per_visit": revenue_per_visit,
    "orphan_facts": orphan_facts,
    "orphan_facts_of_segment": orphan_facts_of_segment,
    "customers_without_visits": customers_without_visits,
    "top_per_segment": top_per_segment,
    "ltv_rollup_region": ltv_rollup_region,
    "tags_normalised": tags_normalised,
    "week_functions": week_functions,
    "parsed_amounts": parsed_amounts,
    "json_round_trip": json_round_trip,
    "union_of_logs": union_of_logs,
    "result_document_top10": result_document_top10,
    "ingested_ltv": ingested_ltv,
    "ingested_rejects": ingested_rejects,
    "ingested_twice_ltv": ingested_twice_ltv,
    "ingested_customers_only": ingested_customers_only,
    "upserted_ltv": upserted_ltv,
    "upserted_rejects": upserted_rejects,
    "value_store_ltv": value_store_ltv,
    "value_store_calendar_ltv": value_store_calendar_ltv,
    "json_array_ltv": json_array_ltv,
    "json_array_lines_ltv": json_array_lines_ltv,
    "json_lines_ltv": json_lines_ltv,
    "json_array_rejects": json_array_rejects,
    "json_split_arrays_ltv": json_split_arrays_ltv,
    "json_salvaged_rejects": json_salvaged_rejects,
    "json_with_empty_folder_ltv": json_with_empty_folder_ltv,
    "json_missing_fields": json_missing_fields,
    "events_by_inline_kind": events_by_inline_kind,
    "stream_json_ltv": stream_json_ltv,
    "event_log_by_type_verb": event_log_by_type_verb,
    "stream_state_equals_batch": stream_state_equals_batch,
    "stream_partials_ltv": stream_partials_ltv,
    "stream_compacted_ltv": stream_compacted_ltv,
    "stream_ltv_top10": stream_ltv_top10,
    "stream_store_top10": stream_store_top10,
    "stream_store_rejects": stream_store_rejects,
    "stream_weekly_visits": stream_weekly_visits,
    "stream_late_visits": stream_late_visits,
    "stream_first_seen": stream_first_seen,
    "stream_ingested_log": stream_ingested_log,
}


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return published(query(configure(spark), sf_dir))

    run.__doc__ = query.__doc__
    return run


def entry(spark: SparkSession) -> DataFrame:
    """The ten customers of highest lifetime value."""
    return queries()["ltv_fold_top10"](spark, "/root/testdata/sf0.001")


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the subpackage `llm` and the corpus pipeline, if they can be imported."""
    try:
        import corpus_pipeline
        from perennia.llm.oracles import ORACLES as sql
        from perennia.llm.queries import QUERIES as found
    except ImportError:
        return {}, {}
    pipeline_sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**found, "pipeline": corpus_pipeline.run}, {**sql, **pipeline_sql}


def queries() -> dict[str, Query]:
    return {name: _registered(query) for name, query in _QUERIES.items()} | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return ORACLES | _training_data()[1]
