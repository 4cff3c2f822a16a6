"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator of the survey.

Every query reads the driver's tables (the ad-log is derived from ``events``), so its work
grows with the scale factor. Nothing is capped, sampled or filtered by id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens import schema as S
from adlens.functions.geocode import parse_business_areas
from adlens.functions.scalar import in_geo_box, is_blank, lenient_double, lenient_int, not_blank
from adlens.functions.sql_functions import register_sql_functions
from adlens.operators import geo as G
from adlens.operators import identity as Ident
from adlens.operators.component_store import ComponentStore
from adlens.operators.components import connected_components
from adlens.operators.dimensions import resolve_app_name
from adlens.operators.hubs import hub_ids
from adlens.operators.kpi import kpi_report
from adlens.operators.merge import profile_chunks, profile_map, top_tags
from adlens.operators.perturb import perturb_lines
from adlens.operators.tags import FAMILIES_V1, TagContext, register_family, row_tags
from adlens.plans import profiles as P
from adlens.plans import reports as R
from adlens.plans.jobs import etl_job
from adlens.plans.profile_store import ProfileStore
from adlens.plans.report_store import ReportStore
from adlens.session import Scratch, scratch_path
from adlens.sources import derived as D
from adlens.sources.clustered_log import ClusteredLog
from adlens.sources.derived import input_key
from adlens.sources.dictionaries import load_app_dict, load_stopwords, parse_app_dict, stopwords_frame
from adlens.sources.rawlog import read_raw_log, type_log
from adlens.sources.rejects import ingest_with_rejects
from adlens.sources.sinks import read_log, report_lines, write_log, write_partitioned_json, write_profiles
from adlens.streaming.incremental import read_log_stream
from adlens.streaming.worklist import read_worklist, start_worklist

ID_COLS = [c for c, _ in S.ID_COLUMNS]

# How far a point may look for a cached cell.
NEAR_RINGS = 2

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.derived_log(spark, sf_dir)


# --- reports (K2-K9) -------------------------------------------------------
@register("kpi_by_location")
def q_kpi_by_location(spark, sf_dir):
    return R.report_location(_log(spark, sf_dir))


@register("kpi_by_os")
def q_kpi_by_os(spark, sf_dir):
    return R.report_os(_log(spark, sf_dir))


@register("kpi_by_device")
def q_kpi_by_device(spark, sf_dir):
    return R.report_device(_log(spark, sf_dir))


@register("kpi_by_network")
def q_kpi_by_network(spark, sf_dir):
    return R.report_network(_log(spark, sf_dir))


@register("kpi_by_carrier")
def q_kpi_by_carrier(spark, sf_dir):
    return R.report_carrier(_log(spark, sf_dir))


@register("kpi_by_channel")
def q_kpi_by_channel(spark, sf_dir):
    return R.report_channel(_log(spark, sf_dir))


@register("city_count")
def q_city_count(spark, sf_dir):
    return R.report_city_count(_log(spark, sf_dir))


# --- shared derived inputs -------------------------------------------------------
def _parse_app_dict(spark, sf_dir, keep_trailing: bool) -> DataFrame:
    return parse_app_dict(D.app_dict_lines(spark, sf_dir), keep_trailing)


_DICT_PATHS: dict[tuple, str] = {}


def _app_dict(spark, sf_dir, keep_trailing: bool) -> DataFrame:
    """The parsed dictionary, stored once per session and state of the input (a dictionary is a small input file
    that every report and tag job loads; the parse itself is checked by app_dict_dim*)."""
    key = (*input_key(spark, sf_dir), keep_trailing)
    if key not in _DICT_PATHS:
        path = scratch_path(spark, "app_dict")
        _parse_app_dict(spark, sf_dir, keep_trailing).write.parquet(path)
        _DICT_PATHS[key] = path
    return spark.read.parquet(_DICT_PATHS[key])


_RESPONSE_PATHS: dict[tuple, str] = {}
_GEO_PATHS: dict[tuple, str] = {}


def _geo_responses(spark, sf_dir) -> DataFrame:
    """Stored geocoder responses: one per distinct in-box cell of the log that was geocoded.

    Written once per session and state of the input as a Parquet table (responses are stored data, not a view), so
    later filters and joins read a table instead of re-deriving cells from the log.
    """
    key = input_key(spark, sf_dir)
    if key not in _RESPONSE_PATHS:
        # Stored, so that the filter on responses is not pushed into the scan and the cell computed for each use.
        cells, cells_path = Scratch(spark).write(
            G.in_box_cells(_log(spark, sf_dir).select("long", "lat")).select(G.CELL).distinct(), "geo_cells")
        path = scratch_path(spark, "geo_responses")
        cells.select(G.CELL, F.expr(D.geo_response_expr(G.CELL)).alias("response")) \
             .filter(F.col("response").isNotNull()).write.parquet(path)
        Scratch(spark).drop(cells_path)
        _RESPONSE_PATHS[key] = path
    return spark.read.parquet(_RESPONSE_PATHS[key])


def _geo_dim(spark, sf_dir) -> DataFrame:
    """The cache table, stored: its size is measured before each join."""
    key = input_key(spark, sf_dir)
    if key not in _GEO_PATHS:
        path = scratch_path(spark, "geo_dim")
        G.geo_dimension(_geo_responses(spark, sf_dir)).write.parquet(path)
        _GEO_PATHS[key] = path
    return spark.read.parquet(_GEO_PATHS[key])


def _ctx(spark, sf_dir, stop_as_frame: bool = False, with_geo: bool = True) -> TagContext:
    stop = (stopwords_frame(spark, D.FIXTURE_STOP_WORDS) if stop_as_frame
            else list(D.FIXTURE_STOP_WORDS))
    return TagContext(app_dict=_app_dict(spark, sf_dir, False), stop_words=stop,
                      geo_dim=_geo_dim(spark, sf_dir) if with_geo else None)


def _raw_fields(spark, sf_dir) -> DataFrame:
    return read_raw_log(spark, D.raw_log_path(spark, sf_dir))


# --- ingest: S1-S5, C1-C3 ------------------------------------------------------------
@register("raw_log_parse")
def q_raw_log_parse(spark, sf_dir):
    f = F.col("fields")
    return _raw_fields(spark, sf_dir).select(
        F.size(f).alias("n_fields"), f[0].alias("f_sessionid"), f[22].alias("f_long"),
        f[80].alias("f_keywords"), f[84].alias("f_last"))


@register("raw_log_typed")
def q_raw_log_typed(spark, sf_dir):
    return type_log(_raw_fields(spark, sf_dir))


@register("log_roundtrip")
def q_log_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "adlog_roundtrip")
    write_log(D.derived_log_frame(spark, sf_dir), path)
    return read_log(spark, path)


@register("app_dict_dim")
def q_app_dict_dim(spark, sf_dir):
    return _parse_app_dict(spark, sf_dir, True)


@register("app_dict_dim_tags")
def q_app_dict_dim_tags(spark, sf_dir):
    return _parse_app_dict(spark, sf_dir, False)


@register("lenient_int_cast")
def q_lenient_int_cast(spark, sf_dir):
    f = F.col("fields")
    return _raw_fields(spark, sf_dir).select(
        f[0].alias("f_sessionid"), f[1].alias("raw"), lenient_int(f[1]).alias("as_int"),
        lenient_int(f[9]).alias("price_as_int"), lenient_int(f[8]).alias("mode_as_int"))


@register("lenient_double_cast")
def q_lenient_double_cast(spark, sf_dir):
    f = F.col("fields")
    return _raw_fields(spark, sf_dir).select(
        f[0].alias("f_sessionid"), f[9].alias("raw"), lenient_double(f[9]).alias("as_double"),
        lenient_double(f[1]).alias("id_as_double"), lenient_double(f[23]).alias("lat_as_double"))


@register("blank_filter")
def q_blank_filter(spark, sf_dir):
    return _log(spark, sf_dir).filter(is_blank("adspacetypename") | is_blank("appname")).select(
        "sessionid", is_blank("adspacetypename").alias("name_blank"),
        is_blank("appname").alias("app_blank"), not_blank("imei").alias("has_imei"))


# --- sinks: S7, S8, S10 --------------------------------------------------------------------
@register("city_count_json")
def q_city_count_json(spark, sf_dir):
    path = scratch_path(spark, "city_count_json")
    write_partitioned_json(R.report_city_count(_log(spark, sf_dir)), ["provincename", "cityname"], path)
    return spark.read.schema("ct bigint, provincename string, cityname string").json(path)


@register("report_text_lines")
def q_report_text_lines(spark, sf_dir):
    return report_lines(R.report_location(_log(spark, sf_dir)), ["provincename", "cityname"])


@register("report_text_lines_app")
def q_report_text_lines_app(spark, sf_dir):
    rep = R.report_app(_log(spark, sf_dir), _app_dict(spark, sf_dir, True))
    return report_lines(rep, ["app"])


@register("profile_rendered")
def q_profile_rendered(spark, sf_dir):
    return profile_chunks(P.user_profiles(_log(spark, sf_dir), _ctx(spark, sf_dir)), "user_key")


# --- reports needing the dictionary: K8, J1 ------------------------------------------------
@register("kpi_by_app")
def q_kpi_by_app(spark, sf_dir):
    return R.report_app(_log(spark, sf_dir), _app_dict(spark, sf_dir, True))


@register("resolve_app_name")
def q_resolve_app_name(spark, sf_dir):
    log = _log(spark, sf_dir).select("sessionid", "appid", "appname")
    return resolve_app_name(log, _app_dict(spark, sf_dir, True)).select("sessionid", "app")


# --- geo: C8, C9, C13, J3, J4, T5, P7 ------------------------------------------------------------
@register("geo_box_filter")
def q_geo_box_filter(spark, sf_dir):
    return _log(spark, sf_dir).filter(in_geo_box("long", "lat")).select("sessionid", "long", "lat")


@register("geohash6_cells")
def q_geohash6_cells(spark, sf_dir):
    return G.in_box_cells(_log(spark, sf_dir).select("sessionid", "long", "lat")).select("sessionid", G.CELL)


@register("regeo_parse")
def q_regeo_parse(spark, sf_dir):
    return _geo_responses(spark, sf_dir).select(
        G.CELL, "response", parse_business_areas("response").alias("business_areas"))


@register("business_tags")
def q_business_tags(spark, sf_dir):
    ctx = _ctx(spark, sf_dir)
    return row_tags(_log(spark, sf_dir), ["business"], ctx, ["sessionid"])


@register("business_names_all")
def q_business_names_all(spark, sf_dir):
    return G.lookup_business(_log(spark, sf_dir).select("sessionid", "long", "lat"),
                             _geo_dim(spark, sf_dir), box_filter=False) \
            .select("sessionid", G.CELL, "business_areas")


@register("missing_geo_cells")
def q_missing_geo_cells(spark, sf_dir):
    return G.missing_cells(_log(spark, sf_dir).select("long", "lat"), _geo_dim(spark, sf_dir))


# --- tag families: T1-T7, J2 ---------------------------------------------------------------------
def _family_query(families, stop_as_frame=False):
    def q(spark, sf_dir):
        ctx = _ctx(spark, sf_dir, stop_as_frame, with_geo="business" in families)
        return row_tags(_log(spark, sf_dir), families, ctx, ["sessionid"])
    return q


register("ad_tags")(_family_query(["ad"]))
register("app_tags")(_family_query(["app"]))
register("device_tags")(_family_query(["device"]))
register("location_tags")(_family_query(["location"]))
register("keyword_tags")(_family_query(["keyword"], stop_as_frame=True))
register("row_tags_all")(_family_query(FAMILIES_V1))


# --- profiles and identity: K11-K13, I1-I5, J5 ------------------------------------------------------
@register("user_tag_weights")
def q_user_tag_weights(spark, sf_dir):
    return P.user_profiles(_log(spark, sf_dir), _ctx(spark, sf_dir))


@register("user_key")
def q_user_key(spark, sf_dir):
    return _log(spark, sf_dir).select("sessionid", Ident.user_key().alias("user_key"))


@register("all_ids")
def q_all_ids(spark, sf_dir):
    return _log(spark, sf_dir).select("sessionid", F.array_join(Ident.all_ids(), ",").alias("ids"))


@register("identity_vertices")
def q_identity_vertices(spark, sf_dir):
    return Ident.vertices(Ident.with_ids(_log(spark, sf_dir)))


@register("identity_edges")
def q_identity_edges(spark, sf_dir):
    return Ident.edges(Ident.with_ids(_log(spark, sf_dir)))


@register("connected_components")
def q_connected_components(spark, sf_dir):
    return P.resolve_identities(_log(spark, sf_dir))


@register("event_component")
def q_event_component(spark, sf_dir):
    log = _log(spark, sf_dir)
    labels = P.resolve_identities(log)
    return Ident.attach_component(log.select("sessionid", *ID_COLS), labels, keep=["sessionid"])


@register("component_profiles")
def q_component_profiles(spark, sf_dir):
    return P.person_profiles(_log(spark, sf_dir), _ctx(spark, sf_dir, with_geo=False))


@register("component_members")
def q_component_members(spark, sf_dir):
    labels = P.resolve_identities(_log(spark, sf_dir))
    return P.component_members(labels).select(
        "component", "chunk", "n_items", F.array_join("members", ",").alias("members"))


# --- perturbation: C15 / P6 ---------------------------------------------------------------------------
@register("log_perturb")
def q_log_perturb(spark, sf_dir):
    return perturb_lines(D.raw_lines(spark, sf_dir), seed=7)


# --- files and chains: P1, S5, S6, S10, K14 ------------------------------------------------------------
@register("etl_chain")
def q_etl_chain(spark, sf_dir):
    path = scratch_path(spark, "etl_log")
    etl_job(spark, D.raw_log_path(spark, sf_dir), path)
    return read_log(spark, path)


@register("app_dict_file")
def q_app_dict_file(spark, sf_dir):
    """The dictionary as several text files, whose order decides between lines of one key."""
    path = scratch_path(spark, "app_dict_lines")
    D.app_dict_lines(spark, sf_dir).repartitionByRange(5, "line_no").sortWithinPartitions("line_no") \
        .select("value").write.text(path)
    return load_app_dict(spark, path)


@register("stopwords_file")
def q_stopwords_file(spark, sf_dir):
    path = scratch_path(spark, "stopwords")
    stopwords_frame(spark, D.FIXTURE_STOP_WORDS).write.text(path)
    ctx = TagContext(stop_words=load_stopwords(spark, path))
    return row_tags(_log(spark, sf_dir), ["keyword"], ctx, ["sessionid"])


def _weights(spark, sf_dir) -> DataFrame:
    return P.user_profiles(_log(spark, sf_dir), _ctx(spark, sf_dir))


@register("profile_sink")
def q_profile_sink(spark, sf_dir):
    """One day, and another one that is written anew: three writes of the same weights, which are stored once."""
    path = scratch_path(spark, "profiles")
    scratch = Scratch(spark)
    weights, weights_path = scratch.write(_weights(spark, sf_dir), "weights")
    for day in ("20190921", "20190922", "20190922"):
        write_profiles(profile_chunks(weights, "user_key"), path, day)
    scratch.drop(weights_path)
    return spark.read.parquet(path).withColumn("dt", F.col("dt").cast("string"))


@register("profile_map_rows")
def q_profile_map_rows(spark, sf_dir):
    return profile_map(_weights(spark, sf_dir), "user_key").select(
        "user_key", "chunk", F.explode("profile").alias("tag", "weight"))


@register("profile_rendered_chunked")
def q_profile_rendered_chunked(spark, sf_dir):
    return profile_chunks(_weights(spark, sf_dir), "user_key", chunk_size=8)


@register("component_members_chunked")
def q_component_members_chunked(spark, sf_dir):
    return P.component_members(P.resolve_identities(_log(spark, sf_dir)), chunk_size=3).select(
        "component", "chunk", "n_items", F.array_join("members", ",").alias("members"))


def _family_session(df, ctx):
    """A family a user might add: length of the session id, and carrier."""
    tag = F.concat(F.lit("HX"), F.length("sessionid").cast("string"), F.lit("_"), F.coalesce("ispname", F.lit("-")))
    return df, F.array(F.struct(F.lit("custom").alias("kind"), tag.alias("tag")))


@register("custom_family_tags")
def q_custom_family_tags(spark, sf_dir):
    register_family("custom", _family_session)
    return row_tags(_log(spark, sf_dir), ["custom", "location"], TagContext(), ["sessionid"])


# --- kept up to date: I5 / P4, S10 / P3 -----------------------------------------------------------------
SESSION_NUMBER = "CAST(substr(sessionid, 2) AS BIGINT)"


def _incremental(spark, sf_dir) -> ComponentStore:
    """Three days of the log (dealt by session number), merged one after the other."""
    store = ComponentStore(spark, scratch_path(spark, "component_store"), buckets=16)
    log = _log(spark, sf_dir)
    for day in (1, 2, 3):
        _, edges = P.identity_graph(log.filter(f"{SESSION_NUMBER} % 3 = {day - 1}").select(*ID_COLS))
        store.apply(edges, day)
    return store


@register("components_incremental")
def q_components_incremental(spark, sf_dir):
    """The labels after each day's increment."""
    store = _incremental(spark, sf_dir)
    days = [store.labels(day).select(F.lit(day).alias("day"), "id", "component") for day in (1, 2, 3)]
    return days[0].unionByName(days[1]).unionByName(days[2])


@register("component_renames")
def q_component_renames(spark, sf_dir):
    """Components that the last day gave another name."""
    return _incremental(spark, sf_dir).renames(3)


@register("profile_store_replaced")
def q_profile_store_replaced(spark, sf_dir):
    """Profiles of three days; then the second day is replaced: some rows fewer, and some late ones."""
    store = ProfileStore(spark, scratch_path(spark, "profile_store"), buckets=16)
    log, ctx = _log(spark, sf_dir), _ctx(spark, sf_dir)
    for day in range(3):
        store.put(f"2019092{day}", P.user_profiles(log.filter(f"{SESSION_NUMBER} % 3 = {day}"), ctx))
    late = log.filter(f"({SESSION_NUMBER} % 3 = 1 AND {SESSION_NUMBER} % 5 <> 0) OR {SESSION_NUMBER} % 21 = 0")
    store.put("20190921", P.user_profiles(late, ctx))
    return store.weights()


def _report_store(spark, sf_dir) -> ReportStore:
    """Dirty prices; three days, then the second one is replaced and gets late rows on top."""
    store = ReportStore(spark, scratch_path(spark, "report_store"), buckets=16)
    log = _log(spark, sf_dir).withColumn("winprice", F.expr(D.dirty_price_expr()))
    for day in range(3):
        store.put_log(f"2019092{day}", log.filter(f"{SESSION_NUMBER} % 3 = {day}"))
    store.put_log("20190921", log.filter(f"{SESSION_NUMBER} % 3 = 1 AND {SESSION_NUMBER} % 5 <> 0"))
    store.add_log("20190921", log.filter(f"{SESSION_NUMBER} % 21 = 0"))
    return store


@register("report_store_location")
def q_report_store_location(spark, sf_dir):
    k = F.col("win_price_k")
    kind = F.when(F.isnan(k), "nan").when(F.abs(k) == float("inf"), "infinite").otherwise("finite")
    return _report_store(spark, sf_dir).report("location").withColumn("price_kind", kind).withColumn(
        "win_price_k", F.when(F.col("price_kind") == "finite", k))


@register("report_store_days")
def q_report_store_days(spark, sf_dir):
    """Row counts by city of the last two days, from their parts."""
    return _report_store(spark, sf_dir).city_count(["20190921", "20190922"])


# --- clustered log: S3 / P1 with K11 and J5 --------------------------------------------------------------
def _clustered(spark, sf_dir) -> ClusteredLog:
    path = scratch_path(spark, "clustered_log")
    return ClusteredLog(spark, "log_" + path.rpartition("-")[2], path, buckets=16).write(_log(spark, sf_dir))


@register("clustered_user_weights")
def q_clustered_user_weights(spark, sf_dir):
    return _clustered(spark, sf_dir).weights(_ctx(spark, sf_dir))


@register("clustered_event_component")
def q_clustered_event_component(spark, sf_dir):
    log = _clustered(spark, sf_dir)
    log.write_labels(P.resolve_identities(_log(spark, sf_dir)))
    return log.components(["sessionid"])


# --- rejected lines: S1 / P1 -----------------------------------------------------------------------------
def _ingest(spark, sf_dir):
    """The raw log with blank lines, comments and cut lines in it."""
    raw, out = scratch_path(spark, "broken_log"), scratch_path(spark, "ingest")
    spark.sql(D.broken_line_sql("{src}"), src=D.read_events(spark, sf_dir)).select("value").write.text(raw)
    return ingest_with_rejects(spark, raw, out)


@register("raw_log_rejects")
def q_raw_log_rejects(spark, sf_dir):
    return _ingest(spark, sf_dir).rejected().select(
        "verdict", "line", "n_fields", F.col("file").isNotNull().alias("has_file"), (F.col("block_start") >= 0).alias("has_block"))


@register("raw_log_accepted")
def q_raw_log_accepted(spark, sf_dir):
    return _ingest(spark, sf_dir).log()


# --- geocoder worklist as a stream, near cells: J4, J3 ---------------------------------------------------
@register("geo_worklist_stream")
def q_geo_worklist_stream(spark, sf_dir):
    """The log arrives in three folders; the stream is started anew for each."""
    base, dim = scratch_path(spark, "worklist"), _geo_dim(spark, sf_dir)
    for part in range(3):
        _log(spark, sf_dir).filter(f"{SESSION_NUMBER} % 3 = {part}").write.parquet(f"{base}/log/part={part}")
        stream = read_log_stream(spark, f"{base}/log/*")
        start_worklist(stream, lambda _: dim, f"{base}/cells", f"{base}/state").awaitTermination()
    return read_worklist(spark, f"{base}/cells").select(G.CELL)


@register("business_near")
def q_business_near(spark, sf_dir):
    """Points that lie beside the cells of the log, against the cells that were geocoded."""
    points = _log(spark, sf_dir).select("sessionid", "long", "lat").withColumns(
        {c: F.expr(e) for c, e in D.drift_exprs().items()})
    return G.nearest_cached(G.in_box_cells(points), _geo_dim(spark, sf_dir), max_ring=NEAR_RINGS)


# --- heaviest tags: K11, K14 -----------------------------------------------------------------------------
@register("user_top_tags")
def q_user_top_tags(spark, sf_dir):
    return top_tags(_weights(spark, sf_dir), "user_key", 5)


@register("user_top_tags_by_kind")
def q_user_top_tags_by_kind(spark, sf_dir):
    return top_tags(_weights(spark, sf_dir), "user_key", 2, kind=True)


# --- hub ids: I1, I2, I4 --------------------------------------------------------------------------------
HUB_DEGREE = 40


def _planted(spark, sf_dir) -> DataFrame:
    """The log with a placeholder IMEI on one row of nine, and one MAC of all rows of one row in thirty-one."""
    return _log(spark, sf_dir).withColumns({c: F.expr(e) for c, e in D.placeholder_exprs().items()})


@register("hub_ids")
def q_hub_ids(spark, sf_dir):
    return hub_ids(Ident.with_ids(_planted(spark, sf_dir).select(*ID_COLS)), default=HUB_DEGREE)


def _stored_lists(spark, log) -> DataFrame:
    """The distinct id lists, which hubs, edges and heads are all taken from."""
    return Scratch(spark).write(P.id_lists(log), "id_lists")[0]


@register("components_without_hubs")
def q_components_without_hubs(spark, sf_dir):
    log = _planted(spark, sf_dir)
    lists = _stored_lists(spark, log)
    return P.resolve_identities(log, hubs=hub_ids(lists, default=HUB_DEGREE), lists=lists)


@register("component_profiles_without_hubs")
def q_component_profiles_without_hubs(spark, sf_dir):
    log = _planted(spark, sf_dir)
    lists = _stored_lists(spark, log)
    hubs = hub_ids(lists, default=HUB_DEGREE)
    return P.person_profiles(log, _ctx(spark, sf_dir, with_geo=False), hubs=hubs, lists=lists)


# --- hard inputs: K1, I5, J4 ---------------------------------------------------------------------------
@register("kpi_dirty_amounts")
def q_kpi_dirty_amounts(spark, sf_dir):
    """The vector by city over a log with rare NaN, infinite and huge prices."""
    log = _log(spark, sf_dir).withColumn("winprice", F.expr(D.dirty_price_expr()))
    k = F.col("win_price_k")
    kind = F.when(F.isnan(k), "nan").when(F.abs(k) == float("inf"), "infinite").otherwise("finite")
    return kpi_report(log, ["provincename", "cityname"]).withColumn("price_kind", kind).withColumn(
        "win_price_k", F.when(F.col("price_kind") == "finite", k))


@register("identity_chain_components")
def q_identity_chain_components(spark, sf_dir):
    """Long chains over consecutive events, with scrambled ids."""
    edges = spark.sql(D.chain_edge_sql("{src}"), src=D.read_events(spark, sf_dir))
    return connected_components(edges)


@register("geo_dim_upsert")
def q_geo_dim_upsert(spark, sf_dir):
    cells = G.in_box_cells(_log(spark, sf_dir).select("long", "lat")).select(G.CELL).distinct()
    fetched = cells.select(G.CELL, F.explode(F.array(F.lit(1), F.lit(2))).alias("at")).select(
        G.CELL, "at", F.expr(D.new_response_expr(G.CELL, "at")).alias("response"))
    return G.upsert_cells(_geo_dim(spark, sf_dir), fetched.filter("response is not null"), order_col="at")


# --- T1-T7, C8, C9, C13 from SQL alone ---------------------------------------------------------------
@register("sql_row_tags")
def q_sql_row_tags(spark, sf_dir):
    """T7 in SQL: every family of a row, with the dictionary and the cells as equi joins."""
    ctx = _ctx(spark, sf_dir)
    register_sql_functions(spark, ctx.stop_words)
    return spark.sql("""
        SELECT sessionid, inline(tags) AS (kind, tag) FROM (
            SELECT sessionid, concat(
                adlens_ad_tags(adspacetype, adspacetypename, adplatformproviderid),
                adlens_app_tags(appname, appname_dict), adlens_business_tags(business_areas),
                adlens_device_tags(client, networkmannername, ispname),
                adlens_location_tags(provincename, cityname), adlens_keyword_tags(keywords)) AS tags
            FROM (SELECT *, CASE WHEN adlens_in_geo_box(long, lat) THEN adlens_geohash6(
                      adlens_lenient_double(lat), adlens_lenient_double(long)) END AS cell FROM {log}) l
            LEFT JOIN {apps} a ON l.appid = a.appid
            LEFT JOIN {cells} g ON l.cell = g.geohash6)
    """, log=_log(spark, sf_dir), apps=ctx.app_dict, cells=ctx.geo_dim)


@register("sql_geohash_cells")
def q_sql_geohash_cells(spark, sf_dir):
    register_sql_functions(spark)
    return spark.sql("""
        SELECT sessionid, adlens_geohash6(adlens_lenient_double(lat), adlens_lenient_double(long)) AS geohash6
        FROM {log} WHERE adlens_in_geo_box(long, lat)""", log=_log(spark, sf_dir))


@register("sql_regeo_parse")
def q_sql_regeo_parse(spark, sf_dir):
    register_sql_functions(spark)
    return spark.sql("SELECT geohash6, response, adlens_business_areas(response) AS business_areas FROM {responses}",
                     responses=_geo_responses(spark, sf_dir))
