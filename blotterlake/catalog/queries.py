"""One query per operator, on tables derived from the driver's."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from blotterlake.catalog.fixture import charge_crosswalk, incidents, table, unit_beats
from blotterlake.config import MANUAL_RULES, Settings
from blotterlake.functions.dates import (
    nearest_quarter, round_quarter_hour, rounded_minute_fraction, time_of_day,
)
from blotterlake.functions.keys import number_key
from blotterlake.functions.severity import charge_type, severity_code
from blotterlake.functions.text import clean_text, title_case_name
from blotterlake.operators import bayes, density, hourly, incremental, lookups, network, quality, rules, schema
from blotterlake.operators.fuzzy import fuzzy_match
from blotterlake.operators.stemming import clean_texts
from blotterlake.plans import classify as cascade
from blotterlake.plans.analyse import time_of_day_tables
from blotterlake.plans.prepare import add_date_parts, add_severity_codes, key_columns, prepare
from blotterlake.session import materialize, scratch_path, ship_package
from blotterlake.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# DuckDB has no stemmer, so queries it checks leave stemming out.
PLAIN = Settings(stem=False)
CLASSIFIED = [
    name(i) for i in PLAIN.slot_numbers for name in (PLAIN.micro, PLAIN.macro, PLAIN.police)
]


def query(function: Query) -> Query:
    """Register a query; a ``_query`` ending only avoids the name of an imported function."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__.removesuffix("_query")] = run
    return function


# ---- shared steps -------------------------------------------------------------------------


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    return prepare(incidents(spark, sf), unit_beats(spark, sf), PLAIN)


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared rows with the police flag of slot 1 by direct match, and the lead charge."""
    values = cascade.crosswalk_values(charge_crosswalk(spark, sf))
    flag = values.select(
        F.col("description").alias(PLAIN.description(1)), F.col("police").alias(PLAIN.police(1))
    )
    return hourly.lead_charge(prepared(spark, sf).join(flag, PLAIN.description(1), "left"))


def descriptions(spark: SparkSession, sf: str) -> DataFrame:
    return cascade.describe(incidents(spark, sf), PLAIN)


def to_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Cascade without the classifiers."""
    crosswalk = charge_crosswalk(spark, sf)
    values = cascade.crosswalk_values(crosswalk)
    stored = materialize(descriptions(spark, sf), "descriptions")
    matched = cascade.direct_stage(stored, values)
    matched = cascade.fuzzy_stage(matched, values, PLAIN)
    return cascade.rule_stage(matched, cascade.macro_values(crosswalk), PLAIN)


def with_text(df: DataFrame) -> DataFrame:
    return df.withColumn("text", clean_text(F.col("description"), stem=False))


# ---- sources and sinks --------------------------------------------------------------------


@query
def scan_incidents(spark, sf):
    path = scratch_path(spark, "scan-incidents")
    tables.write_table(incidents(spark, sf), path)
    scanned = tables.read_incidents(spark, path, schema=tables.incident_schema())
    return scanned.select("arrest_id", "charge_1_description", "charge_1_class", "beat")


@query
def scan_unit_beat_crosswalk(spark, sf):
    path = scratch_path(spark, "unit-beats")
    unit_beats(spark, sf).select("unit", "beat").write.option("header", True).csv(path)
    return tables.read_unit_beats(spark, path).select("unit", "beat")


@query
def crosswalk_lookups(spark, sf):
    """From a CSV with headers of mixed case in another order, a column too many, and quotes."""
    path = scratch_path(spark, "charge-crosswalk")
    charge_crosswalk(spark, sf).select(
        F.col("police_related").cast("string").alias("Police Related"), F.lit("x,\n\"").alias("Note"),
        F.col("macro_category").alias("macro-category"),
        F.concat("description", F.lit(' "x", y')).alias("DESCRIPTION"), F.col("micro_category").alias("Micro_Category"),
    ).write.option("header", True).option("escape", '"').csv(path)
    lookup = tables.crosswalk_lookups(tables.read_charge_crosswalk(spark, path))
    out = None
    for name, df in lookup._asdict().items():
        key, value = df.columns
        rows = df.select(
            F.lit(name).alias("lookup"), F.col(key).alias("key"),
            F.col(value).cast("string").alias("value"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def read_or_build(spark, sf):
    path = scratch_path(spark, "read-or-build")
    build = lambda: prepared(spark, sf).select("arrest_id", "beat", "unit", "arrest_year")
    tables.read_or_build(spark, path, build)
    # The second call finds the stored table and must not build again.
    return tables.read_or_build(spark, path, lambda: None)


@query
def sink_roundtrip_parquet(spark, sf):
    path = scratch_path(spark, "sink-parquet")
    tables.publish_table(prepared(spark, sf), path, partition_by=("arrest_year",), file_bytes=1 << 20)
    back = tables.read_table(spark, path)
    return back.select("arrest_id", "arrest_year", "unit", "beat", "arrest_time", "charge_2_class")


@query
def sink_roundtrip_csv(spark, sf):
    path = scratch_path(spark, "sink-csv")
    rows = prepared(spark, sf).select(
        "arrest_id", F.concat(F.lit('"a"\n,'), "charge_1_description").alias("charge_1_description"), "unit", "beat", "arrest_time"
    )
    tables.write_shared_csv(rows, path)
    return tables.read_shared_csv(spark, path, rows.schema)


@query
def geo_points(spark, sf):
    """GeoJSON collections of up to 1000 suppliers, written and then scanned feature by feature."""
    path = scratch_path(spark, "points")
    s = table(spark, sf, "supplier")
    feature = F.struct(
        F.struct(
            F.col("s_name").alias("dist_label"), F.col("s_suppkey").cast("string").alias("dist_num")
        ).alias("properties"),
        F.struct(
            F.array(F.col("s_acctbal") / 100, F.col("s_suppkey") / F.lit(8.0)).alias("coordinates")
        ).alias("geometry"),
    )
    block = F.floor(F.col("s_suppkey") / 1000).alias("block")
    collections = s.groupBy(block).agg(F.collect_list(feature).alias("features"))
    collections.write.json(path)
    points = tables.read_points(spark, path, "dist_label string, dist_num string", feature_start='{"properties":')
    return points.select(
        "dist_label", "dist_num", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat")
    )


# ---- schema and projection ----------------------------------------------------------------


@query
def normalize_columns(spark, sf):
    c = table(spark, sf, "customer")
    mixed = c.toDF("C CustKey", "C-Name", "c_NationKey", "C Acct-Bal", "c_mktSegment")
    return schema.normalize_columns(mixed)


def profiled_input(spark, sf) -> DataFrame:
    odd = F.col("arrest_id") % 3
    return incidents(spark, sf).select(
        "arrest_id", "district", "beat", "charge_1_class", "charge_1_description", "last_name",
        F.col("received_in_lockup").alias("lockup_date"),
        F.col("middle_name").alias("date_kind"),
        F.when(odd == 0, "true").when(odd == 1, "False").alias("is_flagged"),
        (F.col("arrest_id") % 100).cast("bigint").alias("small_number"),
        ((F.col("arrest_id") % 1000) / F.lit(10.0)).alias("tenth"),
    )


@query
def profile_columns(spark, sf):
    return schema.profile_columns(profiled_input(spark, sf))


def _typed_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: its type after narrowing and the sum of its values."""
    sums = df.agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in columns])
    return sums.unpivot([], columns, "column_name", "total").select(
        "column_name",
        F.element_at(
            F.create_map(
                *[F.lit(x) for c in columns for x in (c, df.schema[c].dataType.simpleString())]
            ),
            F.col("column_name"),
        ).alias("type_name"),
        F.round("total", 2).alias("total"),
    )


@query
def narrow_ints(spark, sf):
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return _typed_summary(schema.optimize_types(table(spark, sf, "lineitem").select(*columns)), columns)


@query
def narrow_floats(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    return _typed_summary(schema.optimize_types(table(spark, sf, "lineitem").select(*columns)), columns)


@query
def detect_dates(spark, sf):
    typed = schema.optimize_types(
        profiled_input(spark, sf).select("arrest_id", "lockup_date", "date_kind")
    )
    return typed.select(
        F.col("arrest_id").cast("bigint").alias("arrest_id"),
        F.date_format("lockup_date", "yyyy-MM-dd HH:mm:ss").alias("lockup_date"),
        "date_kind",
        F.typeof("lockup_date").alias("lockup_type"),
        F.typeof("date_kind").alias("kind_type"),
    )


@query
def detect_booleans(spark, sf):
    typed = schema.optimize_types(profiled_input(spark, sf).select("arrest_id", "is_flagged"))
    return typed.select(
        F.col("arrest_id").cast("bigint").alias("arrest_id"), "is_flagged",
        F.typeof("is_flagged").alias("type_name"),
    )


@query
def detect_categories(spark, sf):
    names = ["charge_1_class", "charge_1_description", "last_name", "date_kind"]
    source = profiled_input(spark, sf).select(*names).withColumnRenamed("date_kind", "kind")
    typed = schema.optimize_types(source)
    columns = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in typed.columns]
    values = typed.select(F.explode(F.array(*columns)).alias("v")).select("v.*")
    return values.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


@query
def forced_casts(spark, sf):
    forced = schema.force_types(
        incidents(spark, sf),
        {"bigint": ["cb_no", "case_number", "middle_name"], "timestamp_ntz": ["received_in_lockup"]},
        on_error="null",
    )
    return forced.select(
        "arrest_id", "cb_no", "case_number", "middle_name",
        F.date_format("received_in_lockup", "yyyy-MM-dd HH:mm:ss").alias("received"),
    )


@query
def redact(spark, sf):
    kept = schema.drop_columns(schema.redact(incidents(spark, sf), PLAIN.redact), PLAIN.drop)
    column = F.struct(F.lit(len(kept.columns)).alias("n_columns"), F.lit(",".join(sorted(kept.columns))).alias("columns"))
    return kept.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", column.alias("c")).select("n_rows", "c.*")


@query
def prep_districts(spark, sf):
    return incidents(spark, sf).select("arrest_id", number_key(F.col("district")).alias("district"))


@query
def prep_beats(spark, sf):
    wide = F.when(F.col("arrest_id") % 5 == 0, F.col("beat") + 12000.75).otherwise(F.col("beat"))
    return incidents(spark, sf).select("arrest_id", number_key(wide, 4).alias("beat"))


@query
def date_parts(spark, sf):
    parts = add_date_parts(incidents(spark, sf))
    return parts.select("arrest_id", "arrest_year", "arrest_month", "arrest_day", "arrest_hour")


@query
def round_quarter_hour_query(spark, sf):
    ts = F.col("arrest_date")
    return incidents(spark, sf).select(
        "arrest_id",
        ((nearest_quarter(ts) % 4) * 15).cast("int").alias("minute"),
        F.date_format(round_quarter_hour(ts), "yyyy-MM-dd HH:mm:ss").alias("rounded"),
    )


@query
def time_of_day_query(spark, sf):
    ts = F.col("arrest_date")
    return incidents(spark, sf).select(
        "arrest_id",
        rounded_minute_fraction(ts).alias("arrest_minute"),
        time_of_day(ts).alias("arrest_time"),
        time_of_day(ts, carry_hour=True).alias("arrest_time_carried"),
    )


@query
def surrogate_id(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type", "value")
    return schema.surrogate_id(rows, ["event_type", "event_id"])


@query
def severity_codes(spark, sf):
    coded = add_severity_codes(incidents(spark, sf))
    return coded.select("arrest_id", *[f"charge_{i}_class_cat_code" for i in PLAIN.slot_numbers])


@query
def charge_type_bucket(spark, sf):
    code = severity_code(F.col("charge_1_class"))
    typed = incidents(spark, sf).select("arrest_id", code.alias("code"))
    return typed.withColumn("charge_type", charge_type(F.col("code")))


@query
def titlecase(spark, sf):
    named = incidents(spark, sf).select("arrest_id", "first_name", "last_name")
    return schema.titlecase_columns(named, ["first_name", "last_name"])


@query
def category_domain(spark, sf):
    return schema.category_domain(incidents(spark, sf), "charge_1_class")


@query
def hour_angle(spark, sf):
    parts = add_date_parts(incidents(spark, sf))
    n_hours = hourly.count_distinct_hours(parts).scalar()
    angle = hourly.hour_angle(F.col("arrest_hour"), n_hours)
    return parts.select("arrest_id", "arrest_hour", F.round(angle, 6).alias("arrest_time_angle"))


@query
def fill_keys(spark, sf):
    return schema.fill_keys(prepared(spark, sf)).select("arrest_id", "unit", "beat")


# ---- filters ------------------------------------------------------------------------------


@query
def filter_year(spark, sf):
    orders = table(spark, sf, "orders")
    rows = hourly.filter_year(orders, 1995, date_col="o_orderdate")
    return rows.select("o_orderkey", F.year("o_orderdate").alias("o_year"))


@query
def unmapped(spark, sf):
    open_rows = flagged(spark, sf).where(
        lookups.unmapped(F.col(PLAIN.description(1)), F.col(PLAIN.police(1)))
    )
    return open_rows.select("arrest_id", PLAIN.description(1))


@query
def training_pairs(spark, sf):
    rows = to_rules(spark, sf).select("description", "micro", "n_train", "n_test")
    return bayes.training_pairs(rows.where("n_train + n_test > 0"), "description", "micro")


@query
def zscore_filter(spark, sf):
    scored = hourly.with_zscore(hourly.with_charge_type(hourly.hourly_counts(flagged(spark, sf))))
    kept = hourly.remove_outliers(scored, 1.5, zscore_col="arrest_id_count_zscore")
    return kept.select(*hourly.COUNT_KEYS, "arrest_id_count")


# ---- joins and rules ----------------------------------------------------------------------


@query
def lookup_unit(spark, sf):
    keyed = key_columns(incidents(spark, sf))
    return lookups.lookup_unit(keyed, unit_beats(spark, sf)).select("arrest_id", "beat", "unit")


@query
def direct_match(spark, sf):
    values = cascade.crosswalk_values(charge_crosswalk(spark, sf))
    matched = cascade.direct_stage(descriptions(spark, sf), values)
    return matched.select("description", "micro", "police", "n_slot_1", "n_slot_2")


@query
def macro_rollup(spark, sf):
    macros = cascade.macro_values(charge_crosswalk(spark, sf))
    matched = to_rules(spark, sf).drop("macro")
    return lookups.lookup_value(matched, macros, "micro").select("description", "micro", "macro")


def unmatched_descriptions(spark, sf) -> DataFrame:
    keys = charge_crosswalk(spark, sf).select("description").where("description is not null")
    return descriptions(spark, sf).select("description").join(keys, "description", "left_anti")


@query
def unmatched_anti(spark, sf):
    return unmatched_descriptions(spark, sf)


@query
def fuzzy_match_query(spark, sf):
    keys = cascade.crosswalk_values(charge_crosswalk(spark, sf)).select("description")
    return fuzzy_match(unmatched_descriptions(spark, sf), keys, max_distance=4)


@query
def attach_large(spark, sf):
    """Writing back without a broadcast, on rows whose ids are repeated or null."""
    values = cascade.crosswalk_values(charge_crosswalk(spark, sf))
    found = cascade.direct_stage(descriptions(spark, sf), values).join(
        cascade.macro_values(charge_crosswalk(spark, sf)), "micro", "left"
    )
    ids = F.when(F.col("arrest_id") % 5 != 0, F.floor(F.col("arrest_id") / 3))
    rows = incidents(spark, sf).withColumn("arrest_id", ids)
    large = Settings(stem=False, broadcast_bytes=0)
    attached = lookups.attach_resolved(rows, materialize(found, "resolved"), large)
    return attached.select("arrest_id", *map(PLAIN.description, PLAIN.slot_numbers), *CLASSIFIED)


@query
def coalesce_update(spark, sf):
    base = flagged(spark, sf).select("arrest_id", "unit", PLAIN.police(1))
    updates = table(spark, sf, "events").select(
        F.col("event_id").alias("arrest_id"),
        (F.col("value") > 50).alias(PLAIN.police(1)),
        F.lpad(F.col("event_type"), 8, "_").alias("unit"),
    ).where(F.col("arrest_id") % 3 == 0)
    return lookups.coalesce_update(base, updates, "arrest_id", ["unit", PLAIN.police(1)])


@query
def unpivot_charges(spark, sf):
    return lookups.unpivot_charges(incidents(spark, sf))


@query
def pivot_charges(spark, sf):
    long = lookups.unpivot_charges(incidents(spark, sf))
    return lookups.pivot_charges(long, ["description"])


@query
def dedupe_lookup(spark, sf):
    """Which part type each name ends up with, when later part numbers win."""
    parts = table(spark, sf, "part").select("p_name", "p_type", F.col("p_partkey").alias("line_no"))
    pairs_first = lookups.dedupe_lookup(parts, "p_name", "p_type")
    last = lookups.dedupe_lookup(parts, "p_name", "p_type", distinct_pairs_first=False)
    return pairs_first.join(last.toDF("p_name", "p_type_last_row"), "p_name")


@query
def manual_rules(spark, sf):
    values = cascade.crosswalk_values(charge_crosswalk(spark, sf))
    matched = cascade.direct_stage(descriptions(spark, sf), values).withColumn(
        "macro", F.lit(None).cast("string")
    )
    return rules.apply_rules(matched, MANUAL_RULES).select("description", "micro", "macro")


@query
def cascade_methods(spark, sf):
    return to_rules(spark, sf).select(
        "description", "micro", "police", "micro_method", "police_method"
    )


# ---- aggregates ---------------------------------------------------------------------------


@query
def hourly_counts(spark, sf):
    return hourly.hourly_counts(flagged(spark, sf))


@query
def hourly_counts_incremental(spark, sf):
    """Counts of a table by day of the month, brought up to date after its later days were appended."""
    source, store = scratch_path(spark, "by-day"), scratch_path(spark, "counts-by-day")
    rows = materialize(flagged(spark, sf), "flagged")
    for some in (F.col("arrest_day") <= 15, F.col("arrest_day") > 15):
        rows.where(some).write.partitionBy("arrest_day").mode("append").parquet(source)
        groups = incremental.refresh_counts(spark, source, store, hourly.count_groups, column="arrest_day")
    return groups.dropna(subset=list(hourly.COUNT_KEYS)).select(*hourly.COUNT_KEYS, "arrest_id_count")


@query
def total_count(spark, sf):
    return hourly.total_count(hourly.hourly_counts(flagged(spark, sf)))


@query
def year_span(spark, sf):
    return hourly.year_span(table(spark, sf, "orders"), "o_orderdate")


@query
def distinct_hours(spark, sf):
    return hourly.distinct_hours(add_date_parts(incidents(spark, sf)))


@query
def zscore(spark, sf):
    scored = hourly.with_zscore(hourly.with_charge_type(hourly.hourly_counts(flagged(spark, sf))))
    return scored.select(
        *hourly.COUNT_KEYS, "arrest_id_count", "lead_charge_code_type",
        F.round("arrest_id_count_zscore", 6).alias("zscore"),
    )


@query
def radar_series(spark, sf):
    series = hourly.radar_series(hourly.store_groups(flagged(spark, sf)))
    return series.select(
        "chart", *hourly.COUNT_KEYS, "arrest_id_count", "lead_charge_code_type",
        F.round("arrest_id_count_zscore", 6).alias("arrest_id_count_zscore"),
        F.round("arrest_time_angle", 6).alias("arrest_time_angle"),
    )


@query
def pct_of_total(spark, sf):
    groups = hourly.store_groups(flagged(spark, sf))
    total = hourly.total_count(groups.dropna()).scalar()
    return hourly.percent_of_total(hourly.radar_series(groups), total)


@query
def null_key_count(spark, sf):
    return hourly.null_key_count(hourly.store_groups(flagged(spark, sf)))


@query
def preview(spark, sf):
    return schema.preview(prepared(spark, sf), "arrest_id").select("arrest_id", "unit", "beat")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def unit_times(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(density.unit_time_counts(flagged(spark, sf)), "unit-times")


@query
def unit_time_hist(spark, sf):
    counts = density.panels_by_unit(unit_times(spark, sf))
    bins = density.unit_histogram(counts, *density.BY_UNIT)
    return _rounded(bins, "bin_start", "bin_width", "density")


@query
def unit_time_kde(spark, sf):
    counts = density.panels_by_unit(unit_times(spark, sf))
    return _rounded(density.unit_kde(counts, *density.BY_UNIT), "x", "density")


@query
def unit_time_hist_by_flag(spark, sf):
    counts = density.panels_by_flag(unit_times(spark, sf))
    bins = density.unit_histogram(counts, *density.BY_FLAG_AND_UNIT)
    return _rounded(bins, "bin_start", "bin_width", "density")


@query
def unit_time_kde_by_flag(spark, sf):
    counts = density.panels_by_flag(unit_times(spark, sf))
    return _rounded(density.unit_kde(counts, *density.BY_FLAG_AND_UNIT), "x", "density")


@query
def unit_stats(spark, sf):
    """Area under every curve and bar set of the analysis result."""
    stats = time_of_day_tables(flagged(spark, sf), PLAIN)["unit_stats"]
    keys = ["chart", "kind", density.TYPE, density.FLAG, density.UNIT]
    return stats.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"), F.round(F.sum("density"), 6).alias("density_sum")
    )


# ---- network ------------------------------------------------------------------------------


@query
def network_vertices(spark, sf):
    return network.network_vertices(prepared(spark, sf))


@query
def network_edges(spark, sf):
    return network.network_edges(prepared(spark, sf))


@query
def beats_per_unit(spark, sf):
    return network.beats_per_unit(network.network_edges(prepared(spark, sf)))


@query
def network_patterns(spark, sf):
    """Beats of units, and beats that share a unit with a given one, as patterns."""
    facts = network.relations(prepared(spark, sf))
    beats = network.match_patterns(facts, [("isA", "?unit", "unit"), ("assignedTo", "?beat", "?unit")])
    chain = [("assignedTo", "0000", "?unit"), ("isA", "?beat", "beat"), ("assignedTo", "?beat", "?unit")]
    near = network.match_patterns(facts, chain)
    return beats.select(F.lit("beats").alias("pattern"), "beat", "unit").unionByName(
        near.select(F.lit("near").alias("pattern"), "beat", "unit")
    )


# ---- text and classification --------------------------------------------------------------


@query
def clean_text_query(spark, sf):
    return with_text(descriptions(spark, sf).select("description"))


@query
def clean_documents(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", clean_text(F.col("text"), stem=False).alias("text"))


@query
def clean_text_stemmed(spark, sf):
    return clean_texts(table(spark, sf, "documents").select("doc_id", "text"), "text")


@query
def train_test_split(spark, sf):
    rows = table(spark, sf, "events").select("event_id")
    return bayes.train_test_split(rows, "event_id")


@query
def token_counts(spark, sf):
    return bayes.token_counts(table(spark, sf, "documents"), "doc_id", "text")


def fixture_micro_model(spark, sf):
    known = with_text(to_rules(spark, sf)).where("n_train > 0")
    return bayes.fit(known, "text", "micro", weight_col="n_train")


def _rounded_weights(model: bayes.NaiveBayesModel) -> DataFrame:
    return bayes.weights(model).select("label", "word", F.round("weight", 6).alias("weight"))


@query
def nb_weights(spark, sf):
    return _rounded_weights(fixture_micro_model(spark, sf))


def _rounded_scores(said: DataFrame) -> DataFrame:
    return said.withColumn("score", F.round("score", 6))


@query
def nb_predict(spark, sf):
    rows = with_text(descriptions(spark, sf).select("description"))
    model = fixture_micro_model(spark, sf)
    return _rounded_scores(bayes.predict(model, rows, "description", "text"))


@query
def model_roundtrip(spark, sf):
    path = scratch_path(spark, "model")
    bayes.save(fixture_micro_model(spark, sf), path)
    rows = with_text(descriptions(spark, sf).select("description"))
    return _rounded_scores(bayes.predict(bayes.load(spark, path), rows, "description", "text"))


def labelled_documents(spark, sf, label: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    if label != "lang":  # documents without a label are scored too
        docs = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    docs = docs.withColumn("text", clean_text(F.col("text"), stem=False))
    return bayes.train_test_split(docs.select("doc_id", "text", label), "doc_id")


def _judged_documents(spark, sf, label: str) -> DataFrame:
    docs = materialize(labelled_documents(spark, sf, label), "documents")
    model = bayes.fit(docs.where("is_train"), "text", label)
    return docs.select("doc_id", "is_train", label).join(
        bayes.predict(model, docs, "doc_id", "text"), "doc_id"
    )


@query
def nb_documents_lang(spark, sf):
    return _judged_documents(spark, sf, "lang").select("doc_id", "is_train", "lang", "prediction")


@query
def nb_documents_toxic(spark, sf):
    return _judged_documents(spark, sf, "toxic").select("doc_id", "is_train", "toxic", "prediction")


def _stored_resolution(spark, sf) -> cascade.Classification:
    stored = materialize(descriptions(spark, sf), "descriptions")
    return cascade.resolve(stored, charge_crosswalk(spark, sf), PLAIN)


@query
def nlp_micro(spark, sf):
    return _stored_resolution(spark, sf).resolved.select(
        "description", "micro", "macro", "micro_method"
    )


@query
def nlp_police(spark, sf):
    return _stored_resolution(spark, sf).resolved.select("description", "police", "police_method")


@query
def coverage_report(spark, sf):
    return quality.coverage_report(_stored_resolution(spark, sf).resolved, PLAIN)


@query
def accuracy(spark, sf):
    result = _stored_resolution(spark, sf).micro_evaluation.accuracy
    return result.withColumn("accuracy", F.round("accuracy", 6))


@query
def confusion_matrix(spark, sf):
    return quality.confusion_cells(_stored_resolution(spark, sf).micro_evaluation.confusion)


@query
def confusion_csv(spark, sf):
    """The matrix file that a run leaves, read back into its cells."""
    path = scratch_path(spark, "matrix")
    cells = quality.confusion_cells(_stored_resolution(spark, sf).micro_evaluation.confusion)
    tables.write_matrix_csv(quality.confusion_matrix(cells), path)
    wide = spark.read.option("header", True).option("escape", '"').csv(path)
    labels = [c for c in wide.columns if c != "label"]
    long = wide.unpivot(["label"], [F.col(f"`{c}`") for c in labels], "prediction", "n")
    return long.withColumn("n", F.col("n").cast("bigint"))


@query
def binary_confusion(spark, sf):
    return _stored_resolution(spark, sf).police_evaluation.confusion


# ---- whole runs ---------------------------------------------------------------------------


@query
def prepare_incidents(spark, sf):
    return prepared(spark, sf).drop("arrest_date", *PLAIN.timestamp_columns)


@query
def classify_incidents(spark, sf):
    classified, _ = cascade.classify(prepared(spark, sf), charge_crosswalk(spark, sf), PLAIN)
    return classified.select("arrest_id", *CLASSIFIED)


@query
def classify_incidents_stemmed(spark, sf):
    classified, _ = cascade.classify(prepared(spark, sf), charge_crosswalk(spark, sf), Settings())
    return classified.select("arrest_id", *CLASSIFIED)
