"""One registered query per operator: raw inputs from the given tables, then the operator.

``plain`` turns the results into types that print alike everywhere (whole numbers, doubles,
texts), so that values can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import functions as fn
from millrace import operators as op
from millrace.audit import AuditFailed
from millrace.operators.merge import ACTION
from millrace.plans import clean, holidays, late, star
from millrace.sources import SPECS, LandingZone, LoadSpec, files, parse
from millrace.sources.files import FILE
from millrace.storage import work_folder
from millrace.streaming import auto_ingest, merge_deltas, merge_sales_delta
from millrace.tables import TableStore, last_step, log_details, log_step, log_summary

from .inputs import raw, table
from .staging import stage_csv, stage_json_arrays, stage_json_lines, stage_lines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def plain(df: DataFrame) -> DataFrame:
    def show(field: T.StructField):
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            col = col.cast("bigint" if kind.scale == 0 else "double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        return col.alias(field.name)

    return df.select(*[show(f) for f in df.schema.fields])


def register(query: Callable[[SparkSession, str], DataFrame]):
    QUERIES[query.__name__] = lambda spark, sf_dir: plain(query(spark, sf_dir))
    return query


def _zone(spark: SparkSession) -> tuple[LandingZone, str]:
    root = work_folder(spark, "load")
    return LandingZone(spark, f"{root}/raw"), f"{root}/stage"


def _store(spark: SparkSession) -> TableStore:
    return TableStore(spark, work_folder(spark, "tables"))


def _load(spark: SparkSession, spec: LoadSpec, df: DataFrame) -> tuple[LandingZone, DataFrame]:
    """Stage a DataFrame in the spec's format, load it, return zone and raw table."""
    zone, stage = _zone(spark)
    if spec.format == "csv":
        stage_csv(df, stage)
    else:
        stage_json_lines(df, stage, "gzip" if spec.pattern else None)
        spec = spec.with_options(multi_line=False)
    zone.load(spec, stage)
    return zone, zone.table(spec)


# == sources and loading ============================================================================


@register
def read_json_stage(spark, sf):
    path = stage_json_arrays(raw(spark, sf, "staff"), work_folder(spark, "json"))
    return files.read_json(spark, path, ["staff_id", "employee_id"]).drop(FILE)


@register
def read_csv_stage(spark, sf):
    df = raw(spark, sf, "campaigns")
    path = stage_csv(df, work_folder(spark, "csv"))
    return files.read_csv(spark, path, df.columns).drop(FILE)


@register
def csv_ragged_rows(spark, sf):
    customers = table(spark, sf, "customer")
    key, line = F.col("c_custkey"), F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name")
    ragged = (
        F.when(key % 3 == 0, line)
        .when(key % 3 == 1, F.concat_ws(",", line, "c_mktsegment", F.lit("extra"), F.lit("more")))
        .otherwise(F.concat_ws(",", line, F.concat(F.lit('"'), "c_mktsegment", F.lit(', quoted"'))))
    )
    path = stage_lines(customers, ragged, work_folder(spark, "csv"))
    return files.read_csv(spark, path, ["id", "name", "segment"]).drop(FILE)


@register
def read_parquet_stage(spark, sf):
    return files.read_parquet(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderstatus"])


@register
def stage_listing(spark, sf):
    """Orders staged in a folder per priority, then listed: the folders found, and if all have data."""
    _, stage = _zone(spark)
    table(spark, sf, "orders").select("o_orderkey", "o_orderpriority").write.partitionBy("o_orderpriority").parquet(stage)
    listed = files.list_stage(spark, stage, r".*\.parquet")
    folder = F.url_decode(F.regexp_extract("path", r"o_orderpriority=([^/]*)/", 1))
    return listed.groupBy(folder.alias("priority")).agg(F.bool_and(F.col("size") > 0).alias("has_data"))


@register
def file_pattern(spark, sf):
    staff = raw(spark, sf, "staff")
    root = work_folder(spark, "pattern")
    zipped = F.xxhash64("staff_id") % 2 == 0
    stage_json_lines(staff.filter(~zipped), f"{root}/plain")
    stage_json_lines(staff.filter(zipped), f"{root}/zipped", "gzip")
    staff.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{root}/other")
    spec = SPECS["staff"]
    return files.read_json(spark, root, spec.columns, spec.pattern, multi_line=False).drop(FILE)


@register
def load_prefix_or_file(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = stage_csv(orders, work_folder(spark, "prefix"), by="o_orderstatus")
    columns = ["o_orderkey", "o_custkey"]
    whole = files.read_csv(spark, path, columns).select("*", F.lit("prefix").alias("origin"))
    named = files.list_stage(spark, path, ".*o_orderstatus=F/.*").select("path")
    some = files.read_csv(spark, [r["path"] for r in named.toLocalIterator()], columns)
    return whole.unionByName(some.select("*", F.lit("named").alias("origin"))).drop(FILE)


@register
def json_field_project(spark, sf):
    events = table(spark, sf, "events")
    return op.project_json(events, "props", {"k": ("k", "int"), "k_text": ("k", "string"), "none": ("zz", "string")}, ["event_id"])


@register
def csv_position_project(spark, sf):
    df = raw(spark, sf, "campaigns")
    path = stage_csv(df, work_folder(spark, "csv"))
    rows = files.read_csv(spark, path, [f"c{i}" for i in range(1, 10)])
    return op.project_positions(
        rows, [(1, "int", "campaign_id"), (4, "bigint", "impressions"), (7, "decimal(12,2)", "spend"), (8, "date", "start_date")]
    )


@register
def copy_positional(spark, sf):
    return _load(spark, SPECS["campaigns"], raw(spark, sf, "campaigns"))[1]


@register
def copy_continue(spark, sf):
    path = stage_csv(raw(spark, sf, "sales"), work_folder(spark, "csv"))
    spec = SPECS["sales"]
    marked = parse(files.read_csv(spark, path, spec.columns), spec)
    return marked.drop("_raw", FILE).withColumnRenamed("_error", "error")


@register
def copy_abort(spark, sf):
    """A dirty file stops the load and leaves nothing behind; a clean one loads."""
    zone, stage = _zone(spark)
    strict = SPECS["sales"].with_options(on_error="abort")
    sales = raw(spark, sf, "sales")
    stage_csv(sales, f"{stage}/dirty")
    try:
        zone.load(strict, f"{stage}/dirty")
    except Exception as failure:
        if "aborted" not in str(failure):
            raise
    after_dirty = zone.table(strict).agg(F.count(F.lit(1)).alias("n")).select(F.lit("dirty").alias("files"), "n")
    stage_csv(sales.filter(F.col("volume_sold") != "bad"), f"{stage}/clean")
    zone.load(strict, f"{stage}/clean")
    after_clean = zone.table(strict).agg(F.count(F.lit(1)).alias("n")).select(F.lit("clean").alias("files"), "n")
    return after_dirty.unionByName(after_clean)


@register
def copy_skip_file(spark, sf):
    """A file with a bad row is left out whole; there is one file per month."""
    zone, stage = _zone(spark)
    spec = SPECS["sales"].with_options(on_error="skip_file")
    stage_csv(raw(spark, sf, "sales").withColumn("month", F.date_format("sale_date", "yyyy-MM")), stage, by="month")
    zone.load(spec, stage)
    return zone.table(spec)


def _dirty_assignments(spark, sf):
    df = raw(spark, sf, "assignments")
    number = F.col("branch_id").cast("int")
    return df.select(
        "staff_id",
        "branch_id",
        F.when(number == 13, "tbd").otherwise(F.col("start_date").cast("string")).alias("start_date"),
        F.when(number == 21, "2020-13-45").otherwise(F.coalesce(F.col("end_date").cast("string"), F.lit("NaT"))).alias("end_date"),
    )


@register
def strict_vs_try_cast(spark, sf):
    path = stage_json_lines(_dirty_assignments(spark, sf), work_folder(spark, "json"))
    spec = SPECS["staff_branch_assignments"]
    marked = parse(files.read_json(spark, path, spec.columns, spec.pattern, multi_line=False), spec)
    return marked.select(*spec.columns, "status", F.col("_error").alias("error"))


@register
def load_branches(spark, sf):
    return _load(spark, SPECS["branches"], raw(spark, sf, "branches").select("branch_name", "city_name"))[1]


@register
def load_campaigns(spark, sf):
    return _load(spark, SPECS["campaigns"], raw(spark, sf, "campaigns"))[1]


@register
def load_campaign_channels(spark, sf):
    return _load(spark, SPECS["campaign_channels"], raw(spark, sf, "campaign_channels"))[1]


@register
def load_employees(spark, sf):
    df = raw(spark, sf, "employees")
    hired = F.when(F.col("role") == "bar tender", "soon").otherwise(F.col("hire_date").cast("string"))
    return _load(spark, SPECS["employees"], df.withColumn("hire_date", hired))[1]


@register
def load_products(spark, sf):
    return _load(spark, SPECS["products"], raw(spark, sf, "products"))[1]


@register
def load_staff(spark, sf):
    return _load(spark, SPECS["staff"], raw(spark, sf, "staff"))[1]


@register
def load_staff_branch_assignments(spark, sf):
    return _load(spark, SPECS["staff_branch_assignments"], _dirty_assignments(spark, sf))[1]


@register
def load_sales(spark, sf):
    return _load(spark, SPECS["sales"], raw(spark, sf, "sales"))[1]


@register
def load_cities(spark, sf):
    return _load(spark, SPECS["cities"], raw(spark, sf, "cities").select("city_name"))[1]


@register
def load_history(spark, sf):
    zone, _ = _load(spark, SPECS["sales"], raw(spark, sf, "sales"))
    return zone.load_history(SPECS["sales"], fn.hours_ago(2)).agg(
        F.sum("parsed").alias("parsed"), F.sum("loaded").alias("loaded"), F.sum("rejected").alias("rejected"),
        F.min("first_error").alias("first_error"),
    )


@register
def rejected_rows(spark, sf):
    zone, _ = _load(spark, SPECS["sales"], raw(spark, sf, "sales"))
    rows = zone.rejected_rows(SPECS["sales"], fn.hours_ago(2))
    return rows.select(
        F.get_json_object("_raw", "$.sale_id").alias("sale_id"),
        F.get_json_object("_raw", "$.volume_sold").alias("volume_sold"),
        F.col("_error").alias("error"),
    )


@register
def backfill_new_files(spark, sf):
    """Files that arrive after a load are picked up by the next, the earlier ones are not."""
    zone, stage = _zone(spark)
    spec, products = SPECS["products"], raw(spark, sf, "products")
    late = F.col("price") == "n/a"
    stage_csv(products.filter(~late), stage)
    zone.load(spec, stage)
    stage_csv(products.filter(late), stage)
    zone.refresh(spec, stage)
    zone.refresh(spec, stage)
    return zone.changes_since(spec, 0)


@register
def read_catalog_table(spark, sf):
    raw(spark, sf, "holidays").createOrReplaceTempView("replicated_holidays")
    return spark.table("replicated_holidays")


# == projections and filters ==========================================================================


@register
def rename_passthrough(spark, sf):
    df = raw(spark, sf, "holidays")
    return op.rename_passthrough(df, {"raw_holiday_date": "raw_date", "raw_holiday_name": "holiday_name"})


@register
def null_placeholder(spark, sf):
    df = raw(spark, sf, "holidays").select("raw_date", "holiday_name")
    return op.null_placeholder(df, {"raw_local_name": "string", "raw_year": "int", "raw_date": "string"})


@register
def required_key_filter(spark, sf):
    return op.required_key_filter(raw(spark, sf, "sales").select("sale_id", "product_id"), "sale_id")


@register
def upper_bound_filter(spark, sf):
    df = raw(spark, sf, "assignments").select("staff_id", "start_date")
    return op.upper_bound_filter(df, "start_date", F.lit("1998-06-30").cast("date"))


@register
def post_window_filter(spark, sf):
    df = raw(spark, sf, "products").select("product_id", "product_name", "price")
    return op.first_per_key(df, ["product_id"], [F.col("product_name").desc_nulls_last()])


@register
def boolean_flags(spark, sf):
    day, observed = fn.try_date_multi("raw_date"), fn.try_date_multi("observed")
    return raw(spark, sf, "holidays").select(
        "raw_date", "holiday_name", "observed",
        fn.flag(observed != day).alias("is_observed"),
        fn.flag(F.trim("holiday_type").isin("Religious", "Bank")).alias("is_closed"),
    )


@register
def null_safe_case(spark, sf):
    day = fn.try_date_multi("raw_date")
    return raw(spark, sf, "holidays").select(
        "raw_date", "holiday_name", F.when(day.isNotNull(), F.year(day)).alias("year"),
    )


@register
def preview_limit(spark, sf):
    df = raw(spark, sf, "holidays")
    return op.preview(df, 5, [F.col(c).asc_nulls_last() for c in df.columns])


@register
def select_all_check(spark, sf):
    store = _store(spark)
    store.write(raw(spark, sf, "cities"), "cities")
    store.register("cities", "cities_back")
    return spark.table("cities_back")


# == joins ================================================================================================


@register
def join_normalised_name(spark, sf):
    branches = raw(spark, sf, "branches")
    return clean.match_city(branches, raw(spark, sf, "cities")).select("branch_id", "branch_name", "matched_city_id")


@register
def join_cast_key(spark, sf):
    people = raw(spark, sf, "employees").select(F.col("employee_id").cast("string").alias("id"), "first_name", "role")
    staff = raw(spark, sf, "staff").withColumn("employee_id", F.col("employee_id").cast("string"))
    return op.lookup(staff, people, "employee_id", "id", ["first_name", "role"])


@register
def join_price_fallback(spark, sf):
    sales = clean.typed_sales(raw(spark, sf, "sales"))
    priced = clean.price_fallback(sales, raw(spark, sf, "products"))
    return priced.select(
        "sale_id", "product_id", "volume_sold", "price_raw", "product_price",
        F.coalesce("price_raw", "product_price").alias("price"),
    )


def _sales(spark, sf):
    return clean.sales_clean(raw(spark, sf, "sales"), raw(spark, sf, "products"))


def _written(spark, store, df, name):
    store.write(df, name)
    return store.read(name)


@register
def join_date_dim(spark, sf):
    store = _store(spark)
    sales = _written(spark, store, _sales(spark, sf), "sales")
    dates = _written(spark, store, star.dim_date(sales), "dim_date")
    return star.join_date(sales, dates).select("sale_id", "date_key", "sale_ts")


def _dim(spark, sf, store, name):
    """A dimension built from nothing."""
    step, rows = {
        "dim_city": (star.dim_city, lambda: clean.cities_clean(raw(spark, sf, "cities"))),
        "dim_branch": (star.dim_branch, lambda: clean.branches_clean(raw(spark, sf, "branches"))),
        "dim_product": (star.dim_product, lambda: clean.products_clean(raw(spark, sf, "products"))),
        "dim_staff": (star.dim_staff, lambda: clean.staff_clean(raw(spark, sf, "staff"), raw(spark, sf, "employees"))),
    }[name]
    source = _written(spark, store, rows(), f"clean_{name}")
    return _written(spark, store, step(store.read_or_empty(name, star.SCHEMAS[name]), source), name)


@register
def lookup_product_key(spark, sf):
    dim = _dim(spark, sf, _store(spark), "dim_product")
    return star.lookup_product(clean.typed_sales(raw(spark, sf, "sales")), dim).select("sale_id", "product_id", "product_key")


@register
def lookup_branch_key(spark, sf):
    dim = _dim(spark, sf, _store(spark), "dim_branch")
    return star.lookup_branch(clean.typed_sales(raw(spark, sf, "sales")), dim).select("sale_id", "branch_id", "branch_key")


@register
def lookup_staff_key(spark, sf):
    dim = _dim(spark, sf, _store(spark), "dim_staff")
    return star.lookup_staff(clean.typed_sales(raw(spark, sf, "sales")), dim).select("sale_id", "staff_id", "staff_key")


@register
def lateral_generate(spark, sf):
    """Days between the bounds of every staff member's first and last assignment."""
    spans = raw(spark, sf, "assignments").groupBy("staff_id").agg(
        F.min("start_date").alias("min_d"), F.max("start_date").alias("max_d")
    )
    return op.date_series(spans, "d")


# == aggregations, windows, sorts ============================================================================


@register
def date_bounds(spark, sf):
    return op.date_bounds(raw(spark, sf, "sales"), "sale_date")


@register
def row_count(spark, sf):
    return raw(spark, sf, "branches").agg(F.count(F.lit(1)).alias("n"))


@register
def cities_clean_dedupe(spark, sf):
    df = op.required_key_filter(raw(spark, sf, "cities"), "city_id")
    return op.first_per_key(df, ["city_id"], [F.col("city_name").asc_nulls_last()])


@register
def branches_clean_dedupe(spark, sf):
    df = op.required_key_filter(raw(spark, sf, "branches"), "branch_id")
    return op.first_per_key(df, ["branch_id"], [F.col("branch_name").asc_nulls_last()])


@register
def products_clean_dedupe(spark, sf):
    df = op.required_key_filter(raw(spark, sf, "products"), "product_id")
    return op.first_per_key(df, ["product_id"], [F.col("product_name").asc_nulls_last()])


@register
def staff_latest_hire(spark, sf):
    people = raw(spark, sf, "employees").select("employee_id", "hire_date", "role")
    joined = op.lookup(raw(spark, sf, "staff"), people, "employee_id", "employee_id", ["hire_date", "role"])
    return op.first_per_key(joined, ["staff_id"], [F.col("hire_date").desc_nulls_last()])


@register
def latest_assignment(spark, sf):
    return op.first_per_key(
        raw(spark, sf, "assignments"),
        ["staff_id"],
        [F.coalesce("end_date", F.lit("9999-12-31").cast("date")).desc(), F.col("start_date").desc_nulls_first()],
    )


@register
def latest_sale(spark, sf):
    df = raw(spark, sf, "sales").filter(F.col("sale_id").isNotNull())
    return op.first_per_key(df, ["sale_id"], [F.col("sale_date").desc_nulls_last()])


@register
def last_log_statement(spark, sf):
    """The log's last entry, the log being one step per sales day."""
    store = _store(spark)
    steps = raw(spark, sf, "sales").groupBy(F.col("sale_date").alias("started_at")).agg(F.count(F.lit(1)).alias("n"))
    store.append(
        steps.select(
            F.lit("DAY").alias("step_name"), "started_at", F.col("n").alias("rows_inserted"),
            F.lit(0).cast("long").alias("rows_updated"), F.lit(0).cast("long").alias("rows_deleted"), F.lit("day").alias("notes"),
        ),
        "etl_log_details",
    )
    return last_step(log_details(store))


@register
def holiday_dedupe(spark, sf):
    rows = raw(spark, sf, "holidays").select(
        fn.try_date_multi("raw_date").alias("d"), "holiday_name", fn.try_date_multi("observed").alias("o"), "holiday_type"
    )
    keyed = op.required_key_filter(rows, "d").select(fn.md5_key("d", "holiday_name").alias("holiday_key"), "o", "holiday_type")
    observed = F.col("o")
    return op.first_per_key(keyed, ["holiday_key"], [observed.isNotNull().desc(), observed.desc_nulls_last()])


@register
def sort_nulls_last(spark, sf):
    df = raw(spark, sf, "employees").select("employee_id", "hire_date")
    return df.orderBy(F.col("hire_date").desc_nulls_last(), "employee_id")


@register
def sort_computed_key(spark, sf):
    df = raw(spark, sf, "assignments")
    key = F.coalesce("end_date", F.lit("9999-12-31").cast("date"))
    ties = [F.col(c).asc_nulls_last() for c in ("staff_id", "branch_id")]
    return df.orderBy(key.desc(), F.col("start_date").desc(), *ties)


@register
def top1(spark, sf):
    df = raw(spark, sf, "sales")
    return df.orderBy(F.col("sale_date").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in df.columns]).limit(1)


@register
def limit_n(spark, sf):
    df = raw(spark, sf, "products")
    return op.preview(df, 5, [F.col(c).asc_nulls_last() for c in ("product_id", "product_name")])


# == scalar functions ==============================================================================================


@register
def try_number(spark, sf):
    half = F.concat(F.col("volume_sold"), F.lit("1"))
    return raw(spark, sf, "sales").select(
        "sale_id", fn.try_number("sale_id").alias("sale_number"), fn.try_number("volume_sold").alias("volume"),
        fn.try_number(half).alias("volume_more"), fn.try_number("staff_id").alias("staff"),
    )


@register
def try_decimal(spark, sf):
    return raw(spark, sf, "sales").select(
        "sale_id", fn.try_decimal("volume_sold").alias("volume_sold"), fn.try_decimal("cost").alias("cost"),
        fn.try_decimal(F.concat("cost", F.lit("9"))).alias("rounded"),
        fn.try_decimal(F.concat(F.lit("9999999999"), "cost")).alias("too_large"),
    )


@register
def trim_text(spark, sf):
    return raw(spark, sf, "staff").select(fn.trim_text("staff_id").alias("staff_id"), "employee_id")


@register
def title_case(spark, sf):
    return raw(spark, sf, "products").select(
        "product_id", fn.title_case("product_name").alias("product_name"), fn.title_case("category").alias("category")
    ).unionByName(raw(spark, sf, "cities").select(
        F.col("city_id").alias("product_id"), fn.title_case("city_name").alias("product_name"), F.lit(None).cast("string").alias("category")
    ))


@register
def upper_text(spark, sf):
    return raw(spark, sf, "holidays").select("raw_date", fn.upper_text("holiday_name").alias("holiday_name"))


@register
def null_if(spark, sf):
    return raw(spark, sf, "holidays").select(
        "raw_date", fn.null_if(F.trim("holiday_type"), "").alias("holiday_type"), fn.null_if("raw_date", "TBC").alias("known_date")
    )


@register
def coalesce_default(spark, sf):
    return raw(spark, sf, "assignments").select(
        "staff_id", "branch_id",
        fn.coalesce_default("end_date", F.lit("9999-12-31").cast("date")).alias("end_date"),
        fn.coalesce_default(F.col("end_date").cast("string"), "open").alias("end_text"),
    )


@register
def derived_revenue(spark, sf):
    return _sales(spark, sf).select("sale_id", "price", "volume_sold", "revenue", F.col("revenue").cast("decimal(12,2)").alias("revenue_2"))


@register
def cast_string(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_text"), F.col("o_orderdate").cast("date").cast("string").alias("date_text")
    )


@register
def cast_int(spark, sf):
    return raw(spark, sf, "campaigns").select(fn.cast_int("campaign_id").alias("campaign_id"), fn.cast_int("clicks").alias("clicks"))


@register
def cast_decimal(spark, sf):
    return raw(spark, sf, "sales").select("sale_id", fn.cast_decimal("cost").alias("cost"), fn.cast_decimal("price").alias("price"))


@register
def cast_date(spark, sf):
    return table(spark, sf, "events").select("event_id", F.col("ts").cast("date").alias("day"))


@register
def cast_timestamp_ntz(spark, sf):
    return raw(spark, sf, "campaigns").select("campaign_id", fn.cast_timestamp_ntz("start_date").alias("started"))


@register
def try_timestamp_ntz(spark, sf):
    return raw(spark, sf, "holidays").select("raw_date", "holiday_name", fn.try_timestamp_ntz("raw_date").alias("ts"))


@register
def try_date_multi(spark, sf):
    return raw(spark, sf, "holidays").select("raw_date", "holiday_name", fn.try_date_multi("raw_date").alias("d"))


@register
def date_parts(spark, sf):
    return raw(spark, sf, "assignments").select(
        "staff_id", "start_date", fn.day_part("start_date").alias("day"), fn.month_part("start_date").alias("month"),
        fn.year_part("start_date").alias("year"), fn.quarter_part("start_date").alias("quarter"),
    )


@register
def day_name(spark, sf):
    return raw(spark, sf, "assignments").select("staff_id", "start_date", fn.day_name("start_date").alias("day_name"))


@register
def is_weekend_iso(spark, sf):
    return raw(spark, sf, "assignments").select("staff_id", "end_date", fn.is_weekend_iso("end_date").alias("is_weekend"))


@register
def is_weekend_sun0(spark, sf):
    return raw(spark, sf, "assignments").select("staff_id", "end_date", fn.is_weekend_sun0("end_date").alias("is_weekend"))


@register
def date_add_days(spark, sf):
    return raw(spark, sf, "assignments").select(
        "staff_id", "start_date", fn.date_add_days("start_date", F.col("branch_id").cast("int")).alias("later")
    )


@register
def hours_ago(spark, sf):
    """Rows younger than two hours, the age of an event being taken back from now."""
    events = table(spark, sf, "events")
    made = F.current_timestamp() - F.make_dt_interval(mins=F.col("event_id").cast("int") % 240)
    return events.filter(made >= fn.hours_ago(2)).select("event_id")


@register
def md5_key(spark, sf):
    day = fn.try_date_multi("raw_date")
    return raw(spark, sf, "holidays").select("raw_date", "holiday_name", fn.md5_key(day, "holiday_name").alias("holiday_key"))


@register
def null_safe_differs(spark, sf):
    return raw(spark, sf, "sales").select("sale_id", "price", "revenue", (~F.col("price").eqNullSafe(F.col("revenue"))).alias("differs"))


@register
def audit_timestamp(spark, sf):
    """Rows stamped as they are stored; the stamps must lie between begin and end of the run."""
    store = _store(spark)
    begun = spark.sql("SELECT current_timestamp() AS at").first()["at"]
    stamped = raw(spark, sf, "staff").select("staff_id", F.current_timestamp().alias("at"), F.current_time().alias("time_of_day"))
    store.write(stamped.withColumn("time_of_day", F.col("time_of_day").cast("string")), "stamped")
    ended = spark.sql("SELECT current_timestamp() AS at").first()["at"]
    rows = store.read("stamped")
    return rows.select(
        "staff_id",
        F.col("at").between(F.lit(begun), F.lit(ended)).alias("has_timestamp"),
        (F.substring("time_of_day", 1, 8) == F.date_format("at", "HH:mm:ss")).alias("has_time"),
    )


@register
def concat_text(spark, sf):
    return raw(spark, sf, "holidays").select("raw_date", F.concat(F.coalesce("raw_date", F.lit("")), F.lit("||"), "holiday_name").alias("joined"))


# == table functions and keys =======================================================================================


@register
def date_series(spark, sf):
    return op.date_series(op.date_bounds(raw(spark, sf, "sales"), "sale_date"), "d")


@register
def surrogate_key(spark, sf):
    names = raw(spark, sf, "products").select("product_id").distinct()
    return op.assign_keys(names, "product_key", start=100)


@register
def identity_on_load(spark, sf):
    """Two loads of the same records: numbering goes on, copies get numbers of their own."""
    zone, stage = _zone(spark)
    spec, rows = SPECS["branches"].with_options(multi_line=False), raw(spark, sf, "branches").select("branch_name", "city_name")
    for part in ("one", "two"):
        stage_json_lines(rows, f"{stage}/{part}")
        zone.load(spec, f"{stage}/{part}")
    return zone.table(spec)


# == merges and writes =================================================================================================

_OLD = "Old "


def _earlier(df: DataFrame, key: str, *texts: str) -> DataFrame:
    """An earlier state of clean rows: most of them, with other texts."""
    kept = df.filter(F.left(F.md5(F.col(key).cast("string")), F.lit(1)) < "a")
    return kept.select(*[F.concat(F.lit(_OLD), F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns])


def _two_merges(spark, store, step, name, rows, key, *texts):
    now = _written(spark, store, rows, f"{name}_now")
    for source in (_earlier(now, key, *texts), now):
        store.write(step(store.read_or_empty(name, star.SCHEMAS[name]), source), name)
    return store


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")


def _upsert(spark, sf):
    """Customers merged over an earlier state: names change for some segments only."""
    store = _store(spark)
    now = _customers(spark, sf)
    store.write(_earlier(now, "c_custkey", "c_name", "c_mktsegment"), "customers")
    merged = op.merge(
        store.read("customers"), now, ["c_custkey"], ["c_name"],
        when=lambda t, s: s("c_mktsegment") != "MACHINERY",
    )
    store.write(merged, "customers")
    return store


@register
def merge_upsert(spark, sf):
    return _upsert(spark, sf).read("customers")


@register
def merge_match_join(spark, sf):
    return _upsert(spark, sf).written_rows("customers").select("c_custkey", F.col(ACTION).alias("action"))


@register
def merge_counts(spark, sf):
    return _upsert(spark, sf).merge_counts("customers")


@register
def merge_history(spark, sf):
    """Counts of every version of a table."""
    store = _two_merges(
        spark, _store(spark), star.dim_city, "dim_city", clean.cities_clean(raw(spark, sf, "cities")), "city_id", "city_name"
    )
    parts = [store.merge_counts("dim_city", v).select(F.lit(v).alias("version"), "*") for v in store.versions("dim_city")]
    return reduce(DataFrame.unionByName, parts)


@register
def dim_city(spark, sf):
    rows = clean.cities_clean(raw(spark, sf, "cities"))
    return _two_merges(spark, _store(spark), star.dim_city, "dim_city", rows, "city_id", "city_name").read("dim_city")


@register
def dim_branch(spark, sf):
    rows = clean.branches_clean(raw(spark, sf, "branches"))
    return _two_merges(
        spark, _store(spark), star.dim_branch, "dim_branch", rows, "branch_id", "branch_name", "city_name"
    ).read("dim_branch")


@register
def dim_product(spark, sf):
    rows = clean.products_clean(raw(spark, sf, "products"))
    return _two_merges(
        spark, _store(spark), star.dim_product, "dim_product", rows, "product_id", "product_name", "category"
    ).read("dim_product")


@register
def dim_staff(spark, sf):
    rows = clean.staff_clean(raw(spark, sf, "staff"), raw(spark, sf, "employees"))
    return _two_merges(
        spark, _store(spark), star.dim_staff, "dim_staff", rows, "staff_id", "employee_id", "role"
    ).read("dim_staff")


@register
def dim_date(spark, sf):
    """Calendar of the sales before 1998-06-01, then extended to all sales."""
    store = _store(spark)
    sales = _written(spark, store, clean.typed_sales(raw(spark, sf, "sales")).select("sale_ts"), "sales")
    early = sales.filter(F.col("sale_ts") < F.lit("1998-06-01").cast("timestamp_ntz"))
    store.write(star.dim_date(early), "dim_date")
    store.write(star.dim_date(sales, store.read("dim_date")), "dim_date")
    return store.read("dim_date")


_FIRST = "coalesce(cast(try_cast(sale_id AS bigint) / 10 AS bigint) % 10 <> 0, false)"


def _dimensions(spark, sf, store, sales):
    for name in ("dim_branch", "dim_product", "dim_staff"):
        _dim(spark, sf, store, name)
    store.write(star.dim_date(sales), "dim_date")


def _fact_rows(store, sales):
    return star.fact_rows(
        sales, store.read("dim_date"), store.read("dim_product"), store.read("dim_branch"), store.read("dim_staff")
    )


@register
def fact_sales(spark, sf):
    """Nine tenths of the sales at half price first, then all as they are."""
    store = _store(spark)
    sales = _written(spark, store, _sales(spark, sf), "sales")
    _dimensions(spark, sf, store, sales)
    rows = _fact_rows(store, sales)
    first = rows.filter(F.expr(_FIRST)).withColumn("price", (F.col("price") / 2).cast("decimal(12,2)"))
    star.write_fact(store, first)
    star.write_fact(store, rows)
    return star.read_fact(store)


def _holidays(spark, sf):
    return holidays.holidays_clean(
        raw(spark, sf, "holidays"),
        {"raw_holiday_date": "raw_date", "raw_holiday_name": "holiday_name", "raw_holiday_type": "holiday_type", "raw_observed_date": "observed"},
    )


def _holiday_model(spark, sf):
    store = _store(spark)
    now = _written(spark, store, _holidays(spark, sf), "holidays_now")
    earlier = _earlier(now, "holiday_key").withColumns(
        {
            "holiday_type": F.when(F.month("holiday_date") == 1, "Regional").otherwise(F.col("holiday_type")),
            "local_name": F.lit("before"),
        }
    )
    for step, rows in enumerate((earlier, now), 1):
        holidays.incremental(store, rows.withColumn("run", F.lit(step)), "holidays")
    return store


@register
def merge_if_changed(spark, sf):
    return _holiday_model(spark, sf).read("holidays")


@register
def first_run_or_merge(spark, sf):
    store = _holiday_model(spark, sf)
    parts = [store.merge_counts("holidays", v).select(F.lit(v).alias("run"), "*") for v in store.versions("holidays")]
    return reduce(DataFrame.unionByName, parts)


@register
def insert_select(spark, sf):
    store = _store(spark)
    store.append(raw(spark, sf, "cities").select("city_name"), "names")
    store.append(raw(spark, sf, "branches").select("city_name"), "names")
    return store.read_appended("names", "city_name string")


@register
def create_or_replace_table(spark, sf):
    store = _store(spark)
    store.write(raw(spark, sf, "cities"), "t")
    store.write(raw(spark, sf, "staff"), "t")
    return store.read("t")


@register
def create_view(spark, sf):
    clean.cities_clean(raw(spark, sf, "cities")).createOrReplaceTempView("v_cities_clean")
    return spark.sql("SELECT city_id, city_name FROM v_cities_clean")


@register
def etl_log_row(spark, sf):
    store = _upsert(spark, sf)
    log_step(store, "LOAD_CUSTOMERS", store.merge_counts("customers"), "MERGE from customers")
    detail = last_step(log_details(store)).drop("started_at")
    return detail.join(log_summary(store).select("step_name", "rows_affected"), "step_name")


@register
def publish_snapshot(spark, sf):
    """Published tables keep their state when the originals move on."""
    store, production = _store(spark), _store(spark)
    for name in ("dim_city", "dim_branch"):
        _dim(spark, sf, store, name)
    store.publish(production, ["dim_city", "dim_branch"])
    store.write(store.read("dim_city").withColumn("city_name", F.lit("changed")), "dim_city")
    store.publish(production, ["dim_branch"], copy=True)
    city = production.read("dim_city").select(F.lit("dim_city").alias("name"), F.col("city_id").alias("id"), F.col("city_name").alias("text"))
    branch = production.read("dim_branch").select(F.lit("dim_branch").alias("name"), F.col("branch_id").alias("id"), F.col("branch_name").alias("text"))
    return city.unionByName(branch)


# == clean views and the whole run =======================================================================================


@register
def cities_clean(spark, sf):
    return clean.cities_clean(raw(spark, sf, "cities"))


@register
def branches_clean(spark, sf):
    return clean.branches_clean(raw(spark, sf, "branches"), raw(spark, sf, "cities"))


@register
def products_clean(spark, sf):
    return clean.products_clean(raw(spark, sf, "products"))


@register
def staff_clean(spark, sf):
    return clean.staff_clean(raw(spark, sf, "staff"), raw(spark, sf, "employees"))


@register
def staff_latest_assignment(spark, sf):
    return clean.staff_latest_assignment(raw(spark, sf, "assignments"))


@register
def sales_clean(spark, sf):
    return _sales(spark, sf)


@register
def holidays_clean(spark, sf):
    return _holidays(spark, sf)


RAW_NAMES = ("cities", "branches", "products", "employees", "staff", "assignments", "sales")


@register
def star_build(spark, sf):
    """Raw tables to published star schema; returns the fact with its members' names."""
    store, production = _store(spark), _store(spark)
    star.build(store, {n: raw(spark, sf, n) for n in RAW_NAMES}, production, include_fact=True)
    fact = star.read_fact(production)
    products = production.read("dim_product").select("product_key", "product_name")
    dates = production.read("dim_date").select("date_key", "day_name", "is_weekend")
    rows = op.lookup(fact, products, "product_key", "product_key", ["product_name"])
    return op.lookup(rows, dates, "date_key", "date_key", ["day_name", "is_weekend"])


# == data quality ===========================================================================================================


@register
def check_unique(spark, sf):
    return op.check_unique(raw(spark, sf, "sales"), "sale_id")


@register
def check_not_null(spark, sf):
    return op.check_not_null(raw(spark, sf, "sales"), "price").select("sale_id", "price", "cost")


@register
def check_accepted_values(spark, sf):
    rows = raw(spark, sf, "holidays").select("raw_date", "holiday_name", "holiday_type")
    return op.check_accepted_values(rows, "holiday_type", ["Religious", "Public"])


@register
def check_max_length(spark, sf):
    return op.check_max_length(table(spark, sf, "documents").select("doc_id", "text"), "text", 50).select("doc_id")


@register
def run_checks(spark, sf):
    rows = raw(spark, sf, "holidays")
    return op.run_checks(
        rows,
        [
            op.Unique("raw_date"),
            op.NotNull("holiday_type"),
            op.NotNull("raw_date"),
            op.AcceptedValues("holiday_type", holidays.HOLIDAY_TYPES),
            op.MaxLength("holiday_name", 12),
        ],
    )


@register
def audited_model(spark, sf):
    """The holiday model with one fault per run: what its checks find, and whether it was published."""
    good = _holidays(spark, sf)
    store = _store(spark)
    good = _written(spark, store, good, "holidays_now")
    month = F.month("holiday_date")
    faults = {
        "none": good,
        "unique": good.unionByName(good.filter(month == 1)),
        "null key": good.withColumn("holiday_key", F.when(month != 2, F.col("holiday_key"))),
        "null date": good.withColumn("holiday_date", F.when(month != 3, F.col("holiday_date"))),
        "null name": good.withColumn("holiday_name", F.when(month != 4, F.col("holiday_name"))),
        "other type": good.withColumn("holiday_type", F.when(month == 5, F.lit("Other")).otherwise(F.col("holiday_type"))),
    }
    found = []
    for k, (fault, rows) in enumerate(faults.items()):
        name = f"model_{k}"
        try:
            holidays.incremental(store, rows, name)
            found.append((fault, store.exists(name), None, None, None))
        except AuditFailed as failed:
            kept = store.rejected(name)[failed.mark]
            found += [(fault, store.exists(name), f["test"], f["column"], f["failures"]) for f in kept]
    return spark.createDataFrame(found, "fault string, published boolean, test string, `column` string, failures long")


@register
def expire_versions(spark, sf):
    """Old versions are deleted; a published snapshot of one of them stays readable."""
    store, production = _store(spark), _store(spark)
    cities = clean.cities_clean(raw(spark, sf, "cities"))
    store.write(cities, "cities")
    store.publish(production, ["cities"])
    for k in range(3):
        store.write(cities.withColumn("city_name", F.concat(F.lit(f"v{k} "), "city_name")), "cities")
    store.expire("cities", keep=1, grace=0)
    shown = [(s.read("cities"), label, len(s.versions("cities"))) for s, label in ((store, "store"), (production, "published"))]
    parts = [df.select(F.lit(label).alias("where"), F.lit(n).alias("versions"), "city_id", "city_name") for df, label, n in shown]
    return parts[0].unionByName(parts[1])


# == streaming and change capture ==========================================================================================


def _in_two(spark, sf):
    sales = raw(spark, sf, "sales")
    return sales.filter(F.expr(_FIRST)), sales.filter(~F.expr(_FIRST))


def _ingest_twice(spark, sf, spec):
    zone, stage = _zone(spark)
    for part in _in_two(spark, sf):
        stage_csv(part, stage)
        auto_ingest(zone, spec, stage, f"{stage}-checkpoint").awaitTermination()
    return zone, stage


@register
def auto_ingest_files(spark, sf):
    zone, _ = _ingest_twice(spark, sf, SPECS["sales"])
    return zone.table(SPECS["sales"])


@register
def scheduled_copy(spark, sf):
    """The scheduled load, run once: an identity column is numbered on over two runs."""
    zone, stage = _zone(spark)
    spec = SPECS["branches"].with_options(multi_line=False)
    rows = raw(spark, sf, "branches")
    for part in (rows.filter("city_name = 'nowhere'"), rows.filter("city_name <> 'nowhere'")):
        stage_json_lines(part.select("branch_name", "city_name"), stage)
        auto_ingest(zone, spec, stage, f"{stage}-checkpoint").awaitTermination()
    return zone.table(spec)


@register
def resume_ingest(spark, sf):
    """Stopped and started again from its checkpoint: nothing is lost or read twice."""
    zone, stage = _ingest_twice(spark, sf, SPECS["sales"])
    auto_ingest(zone, SPECS["sales"], stage, f"{stage}-checkpoint").awaitTermination()
    return zone.load_history(SPECS["sales"]).groupBy("load_id").agg(
        F.sum("parsed").alias("parsed"), F.sum("loaded").alias("loaded"), F.sum("rejected").alias("rejected")
    )


@register
def table_changes(spark, sf):
    store = _store(spark)
    now = _written(spark, store, _customers(spark, sf), "now")
    before = _earlier(now, "c_custkey").withColumn(
        "c_name", F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit(_OLD), "c_name")).otherwise(F.col("c_name"))
    )
    gone = before.filter(F.col("c_mktsegment") == "BUILDING").withColumn("c_custkey", -F.col("c_custkey"))
    return op.table_changes(before.unionByName(gone), now, ["c_custkey"])


@register
def version_changes(spark, sf):
    """Two versions of a partitioned table: partitions carried over are not read."""
    store = _store(spark)
    now = _written(spark, store, _customers(spark, sf), "now")
    store.write(now, "customers", ["c_mktsegment"])
    changed = now.filter("c_mktsegment = 'MACHINERY' AND c_custkey % 3 > 0").withColumn(
        "c_name", F.when(F.col("c_custkey") % 3 == 1, F.concat(F.lit(_OLD), "c_name")).otherwise(F.col("c_name"))
    )
    added = now.filter("c_mktsegment = 'MACHINERY' AND c_custkey % 3 = 1").withColumn("c_custkey", -F.col("c_custkey"))
    others = [v for v in store.manifest("customers").partitions if v != "MACHINERY"]
    store.write(changed.unionByName(added), "customers", ["c_mktsegment"], None, others)
    return store.changes("customers", 1, 2, ["c_custkey"])


@register
def has_changes(spark, sf):
    """The gate before and after the changes of a load are taken."""
    zone, _ = _load(spark, SPECS["sales"], raw(spark, sf, "sales"))
    spec = SPECS["sales"]
    states = [(mark, op.has_changes(zone.changes_since(spec, mark))) for mark in (0, zone.last_load(spec.table))]
    return spark.createDataFrame(states, "bookmark long, changed boolean")


@register
def merge_deltas_stream(spark, sf):
    """Sales arrive in two lots; each lot's changes are merged by the stream."""
    zone, stage = _zone(spark)
    store, products = _store(spark), raw(spark, sf, "products")
    for name in ("dim_branch", "dim_product", "dim_staff"):
        _dim(spark, sf, store, name)
    for part in _in_two(spark, sf):
        stage_csv(part, stage)
        merge_deltas(store, zone, SPECS["sales"], products, stage, f"{stage}-checkpoint").awaitTermination()
    return star.read_fact(store).drop("date_key")


@register
def late_members(spark, sf):
    """Sales come before their members: the second lot brings the rest of both."""
    zone, stage = _zone(spark)
    store, spec = _store(spark), SPECS["sales"]
    every = {n: raw(spark, sf, n) for n in ("cities", "branches", "products", "employees", "staff")}
    early = {
        **every,
        "products": every["products"].filter("try_cast(product_id AS INT) % 3 <> 0"),
        "branches": every["branches"].filter("try_cast(branch_id AS INT) % 2 = 0"),
        "staff": every["staff"].filter("staff_id LIKE '%1' OR staff_id LIKE '%2'"),
    }
    for part, members in zip(_in_two(spark, sf), (early, every)):
        stage_csv(part, stage, compression="gzip")
        zone.load(spec, stage)
        merge_sales_delta(store, zone, spec, members["products"], members)
    fact = rows = star.read_fact(store)
    for name, (business_id, key) in late.KINDS.items():
        members = store.read(name).select(F.col(key).alias("_member"), business_id)
        rows = op.lookup(rows, members, key, "_member", [business_id], counted=fact)
    return rows.select("sale_id", *late.IDS, "sale_ts", "volume_sold", "price", "cost", "revenue")


def _rename(old: str, new: str) -> None:
    QUERIES[new] = QUERIES.pop(old)


# Keys that share their name with the function they call.
_rename("auto_ingest_files", "auto_ingest")
_rename("merge_deltas_stream", "merge_deltas")
