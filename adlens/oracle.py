"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each string runs on DuckDB with the driver's tables registered as views. Inputs derived
from ``events`` are rebuilt with the same portable SQL the Spark side uses
(``adlens.sources.derived``); the operators themselves are written here from scratch in SQL.
"""

from __future__ import annotations

from adlens import schema as S
from adlens.functions.geohash import GEOHASH_ALPHABET
from adlens.sources import derived as D

ADLOG = f"adlog AS (\n{D.derived_log_sql('events')}\n)"
RAW = f"raw AS ({D.raw_line_sql('events')}), fields AS (SELECT string_split(value, ',') AS f, value FROM raw)"
STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in D.FIXTURE_STOP_WORDS)


# --- scalar helpers ----------------------------------------------------------------------
def blank(c: str) -> str:
    return rf"({c} IS NULL OR regexp_full_match({c}, '\s*'))"


def not_blank(c: str) -> str:
    return f"(NOT {blank(c)})"


def lenient_int(x: str) -> str:
    return (f"CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') "
            f"THEN coalesce(TRY_CAST({x} AS INTEGER), 0) ELSE 0 END")


def lenient_double(x: str) -> str:
    return (rf"CAST(CASE WHEN regexp_full_match({x}, '(?i)[\x00-\x20]*[+-]?(inf|infinity|nan)[\x00-\x20]*') "
            rf"AND NOT regexp_full_match({x}, '[\x00-\x20]*([+-]?Infinity|[+-]?NaN)[\x00-\x20]*') "
            f"THEN 0.0 ELSE coalesce(TRY_CAST({x} AS DOUBLE), 0.0) END AS DOUBLE)")


IN_BOX = (f"({lenient_double('long')} BETWEEN 73 AND 136 AND {lenient_double('lat')} BETWEEN 3 AND 53)")


def geohash6(lat: str, lon: str) -> str:
    lon_bin = f"least(greatest(CAST(floor(({lon} + 180.0) / 360.0 * 32768.0) AS BIGINT), 0), 32767)"
    lat_bin = f"least(greatest(CAST(floor(({lat} + 90.0) / 180.0 * 32768.0) AS BIGINT), 0), 32767)"
    chars = []
    for ch in range(6):
        terms = []
        for j in range(5):
            t = 5 * ch + j
            src, pos = (lon_bin, t // 2) if t % 2 == 0 else (lat_bin, t // 2)
            terms.append(f"((({src}) >> {14 - pos}) & 1) * {1 << (4 - j)}")
        chars.append(f"substr('{GEOHASH_ALPHABET}', CAST(1 + {' + '.join(terms)} AS INTEGER), 1)")
    return " || ".join(chars)


CELL = f"CASE WHEN {IN_BOX} THEN {geohash6(lenient_double('lat'), lenient_double('long'))} END"
CELL_ALL = geohash6(lenient_double("lat"), lenient_double("long"))


def parse_areas(r: str) -> str:
    arr = f"json_extract({r}, '$.regeocode.addressComponent.businessAreas')"
    return (f"CASE WHEN {r} IS NULL OR NOT json_valid({r}) THEN '' "
            f"WHEN coalesce(TRY_CAST(json_extract_string({r}, '$.status') AS INTEGER), 0) = 0 THEN '' "
            f"WHEN json_type({arr}) IS DISTINCT FROM 'ARRAY' THEN '' "
            f"ELSE array_to_string(list_transform(list_filter(json_extract({r}, "
            f"'$.regeocode.addressComponent.businessAreas[*]'), lambda x: json_type(x) = 'OBJECT'), "
            f"lambda x: coalesce(json_extract_string(x, '$.name'), 'null')), ',') END")


def _ids_list() -> str:
    items = [f"CASE WHEN {not_blank(c)} THEN '{p}' || {c} END" for c, p in S.ID_COLUMNS]
    return f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"


USER_KEY = ("coalesce(" + ", ".join(f"CASE WHEN {not_blank(c)} THEN '{p}' || {c} END"
                                    for c, p in S.ID_COLUMNS) + ", '其他')")


# --- KPI ---------------------------------------------------------------------------------------
_WINS = "iseffective = 1 AND isbilling = 1 AND isbid = 1 AND iswin = 1 AND adorderid <> 0"


def _money(col: str) -> str:
    x = f"coalesce({col}, 0)"
    return (f"(CAST(coalesce(sum(CASE WHEN {_WINS} AND abs({x}) < 1e15 THEN CAST({x} AS DECIMAL(38,10)) END), 0) "
            f"AS DOUBLE) + coalesce(sum(CASE WHEN {_WINS} AND NOT abs({x}) < 1e15 THEN {x} END), 0)) / 1000.0")


KPI_SELECT = f"""
  count(*) FILTER (WHERE requestmode = 1 AND processnode IN (1, 2, 3)) AS raw_req,
  count(*) FILTER (WHERE requestmode = 1 AND processnode IN (2, 3)) AS valid_req,
  count(*) FILTER (WHERE requestmode = 1 AND processnode = 3) AS ad_req,
  count(*) FILTER (WHERE requestmode = 2 AND iseffective = 1) AS shows,
  count(*) FILTER (WHERE requestmode = 3 AND iseffective = 1) AS clicks,
  count(*) FILTER (WHERE iseffective = 1 AND isbilling = 1 AND isbid = 1) AS bids,
  count(*) FILTER (WHERE {_WINS}) AS wins,
  {_money('winprice')} AS win_price_k,
  {_money('adpayment')} AS ad_payment_k"""


def _kpi(dim_select: str, group_by: str, source: str = "adlog", ctes: str = ADLOG) -> str:
    return f"WITH {ctes}\nSELECT {dim_select},{KPI_SELECT}\nFROM {source}\nGROUP BY {group_by}"


def _app_dict(name: str, keep_trailing: bool) -> str:
    text = "value" if keep_trailing else r"regexp_replace(value, '\s+$', '')"
    return (f"{name}_lines AS ({D.app_dict_line_sql('events')}), "
            rf"{name}_f AS (SELECT line_no, string_split_regex({text}, '\s') AS f FROM {name}_lines), "
            f"{name} AS (SELECT f[5] AS appid, arg_max(f[2], line_no) AS appname_dict FROM {name}_f "
            f"WHERE len(f) >= 5 GROUP BY f[5])")


APPDICT_R = _app_dict("appdict_r", True)
APPDICT_T = _app_dict("appdict_t", False)
APP_REPORT = "CASE WHEN {b} THEN coalesce(d.appname_dict, 'unknow') ELSE a.appname END".format(
    b=blank("a.appname"))

GEO = (f"geo_cells AS (SELECT DISTINCT geohash6 FROM (SELECT {CELL} AS geohash6 FROM adlog) c "
       f"WHERE geohash6 IS NOT NULL), "
       f"responses AS (SELECT geohash6, response FROM (SELECT geohash6, {D.geo_response_expr('geohash6')} "
       f"AS response FROM geo_cells) r WHERE response IS NOT NULL), "
       f"geodim AS (SELECT geohash6, business_areas FROM (SELECT geohash6, {parse_areas('response')} "
       f"AS business_areas FROM responses) p WHERE business_areas <> '')")

BASE = (f"base AS (SELECT a.*, {USER_KEY} AS user_key, {CELL} AS geohash6, d.appname_dict, "
        f"{_ids_list()} AS idl FROM adlog a LEFT JOIN appdict_t d ON a.appid = d.appid)")

T_AD = (f"t_ad AS (SELECT sessionid, user_key, 'ad' AS kind, CASE WHEN adspacetype > 9 "
        f"THEN 'LC' || CAST(adspacetype AS VARCHAR) ELSE 'LC0' || CAST(adspacetype AS VARCHAR) END AS tag "
        f"FROM base WHERE coalesce(adspacetype, 0) > 0 "
        f"UNION ALL SELECT sessionid, user_key, 'ad', 'LN' || coalesce(adspacetypename, 'null') FROM base "
        f"WHERE {blank('adspacetypename')} "
        f"UNION ALL SELECT sessionid, user_key, 'ad', 'CN' || CAST(coalesce(adplatformproviderid, 0) AS VARCHAR) "
        f"FROM base)")
T_APP = (f"t_app AS (SELECT sessionid, user_key, 'app' AS kind, 'APP' || CASE WHEN {blank('appname')} "
         f"THEN coalesce(appname_dict, '其他') ELSE appname END AS tag FROM base)")


def _case_map(col: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {col} = {k if isinstance(k, int) else repr(k)} THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE '{default}' END"


T_DEV = (f"t_dev AS (SELECT sessionid, user_key, 'device' AS kind, "
         f"{_case_map('coalesce(client, 0)', S.OS_TAGS, S.OS_TAG_DEFAULT)} AS tag FROM base "
         f"UNION ALL SELECT sessionid, user_key, 'device', "
         f"{_case_map('networkmannername', S.NETWORK_TAGS, S.NETWORK_TAG_DEFAULT)} FROM base "
         f"UNION ALL SELECT sessionid, user_key, 'device', "
         f"{_case_map('ispname', S.CARRIER_TAGS, S.CARRIER_TAG_DEFAULT)} FROM base)")
T_LOC = (f"t_loc AS (SELECT sessionid, user_key, 'location' AS kind, 'ZP' || provincename AS tag FROM base "
         f"WHERE {not_blank('provincename')} UNION ALL SELECT sessionid, user_key, 'location', "
         f"'ZC' || cityname FROM base WHERE {not_blank('cityname')})")
T_KW = (f"t_kw AS (SELECT sessionid, user_key, 'keyword' AS kind, 'K' || w AS tag FROM "
        f"(SELECT sessionid, user_key, unnest(string_split(keywords, '|')) AS w FROM base "
        f"WHERE keywords IS NOT NULL) k WHERE length(w) BETWEEN 3 AND 8 AND w NOT IN ({STOP_SQL}))")
T_BIZ = ("t_biz AS (SELECT sessionid, user_key, 'business' AS kind, name AS tag FROM "
         "(SELECT b.sessionid, b.user_key, unnest(string_split(regexp_replace(g.business_areas, ',+$', ''), ',')) "
         f"AS name FROM base b JOIN geodim g ON b.geohash6 = g.geohash6 WHERE NOT {blank('g.business_areas')} "
         "AND regexp_replace(g.business_areas, ',+$', '') <> '') n)")

TAG_CTES = f"{ADLOG}, {APPDICT_T}, {GEO}, {BASE}, {T_AD}, {T_APP}, {T_DEV}, {T_LOC}, {T_KW}, {T_BIZ}"
V1 = ["t_ad", "t_app", "t_biz", "t_dev", "t_loc", "t_kw"]
V2 = ["t_ad", "t_app", "t_dev", "t_loc", "t_kw"]


def _union(tables: list[str], cols: str = "sessionid, user_key, kind, tag") -> str:
    return " UNION ALL ".join(f"SELECT {cols} FROM {t}" for t in tables)


# --- identity ---------------------------------------------------------------------------------------
GRAPH = ("edges AS (SELECT DISTINCT idl[1] AS src, unnest(idl) AS dst FROM base WHERE len(idl) > 0), "
         "und AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges), "
         "reach(id, root) AS (SELECT a, a FROM und UNION SELECT und.b, reach.root FROM reach "
         "JOIN und ON und.a = reach.id WHERE reach.root < und.b), "
         "cc AS (SELECT id, min(root) AS component FROM reach GROUP BY id), "
         "rowcomp AS (SELECT b.sessionid, cc.component FROM base b JOIN cc ON cc.id = b.idl[1] "
         "WHERE len(b.idl) > 0)")


def _chunk(key: str, sort_key: str, source: str, chunk_size: int = 10000) -> str:
    return (f"SELECT s.*, CAST((('0x' || substr(md5({sort_key}), 1, 8))::BIGINT "
            f"% greatest(CAST(ceil(n.n / {float(chunk_size)}) AS BIGINT), 1)) AS INTEGER) AS chunk "
            f"FROM {source} s JOIN (SELECT {key}, count(*) AS n FROM {source} GROUP BY {key}) n USING ({key})")


# --- perturbation -------------------------------------------------------------------------------------
def _perturb_sql(seed: int) -> str:
    """Rules written out here on their own: column -> replaced character, alphabet and draws, or
    the alphabets (and fixed text) that fill an empty cell."""
    digits, letters, nine = "132456789", "abcd5etshlzbcmpoqw", "012345678"
    replaced = {2: ("0", "01", 1), 8: ("1", "123", 1), 30: ("0", "01", 1), 31: ("0", "01", 1), 35: ("2", "123", 1),
                39: ("0", "01", 1), 40: ("0", digits, 4), 42: ("0", "01", 1), 78: ("0", digits, 4)}
    device = [nine, letters, letters, letters, nine, letters, nine, letters, nine, letters]
    filled = {22: [None, digits, "."] + [digits] * 9, 23: ["23", digits, "."] + [digits] * 9,
              **{c: device for c in range(46, 51)}}

    def one(alphabet, col, k):
        digest = f"md5(md5(value) || ':{col}:{seed}:{k // 4}')"
        number = f"('0x' || substr({digest}, {(k % 4) * 8 + 1}, 8))::BIGINT"
        return f"substr('{alphabet}', CAST({number} % {len(alphabet)} + 1 AS INTEGER), 1)"

    def text(parts, col):
        out, k = [], 0
        for part in parts:
            if part is None or part == ".":
                out.append("'11'" if part is None else "'.'")
            else:
                out.append(one(part, col, k))
                k += 1
        return " || ".join(out)

    out = []
    for i in range(85):
        v = f"f[{i + 1}]"
        if i in replaced:
            ch, alphabet, n = replaced[i]
            v = f"replace({v}, '{ch}', {text([alphabet] * n, i)})"
        elif i in filled:
            v = f"CASE WHEN {v} = '' THEN {text(filled[i], i)} ELSE {v} END"
        out.append(v)
    return f"WITH {RAW}\nSELECT concat_ws(',', {', '.join(out)}) AS value FROM fields"


def _typed_select() -> str:
    cols = []
    for i, (name, kind) in enumerate(S.LOG_COLUMNS):
        v = f"f[{i + 1}]"
        if kind == "I":
            v = lenient_int(v)
        elif kind == "D":
            v = lenient_double(v)
        cols.append(f"{v} AS {name}")
    return ", ".join(cols)


def _report_line(keys: list[str], source: str) -> str:
    if len(keys) == 1:
        key = f"coalesce(CAST({keys[0]} AS VARCHAR), 'null')"
    else:
        key = "'(' || " + " || ',' || ".join(f"coalesce(CAST({k} AS VARCHAR), 'null')" for k in keys) + " || ')'"
    metrics = " || ',' || ".join(f"CAST(CAST({m} AS DOUBLE) AS VARCHAR)" for m in S.KPI_NAMES)
    return f"SELECT {key} || ',' || {metrics} AS value FROM {source}"


# ======================================================================================================
ORACLE: dict[str, str] = {}

# reports
ORACLE["kpi_by_location"] = _kpi("provincename, cityname", "provincename, cityname")
ORACLE["kpi_by_os"] = _kpi("CASE client WHEN 1 THEN 'android' WHEN 2 THEN 'ios' ELSE '其他' END AS os", "1")
ORACLE["kpi_by_device"] = _kpi("CASE devicetype WHEN 1 THEN '手机' WHEN 2 THEN '平板' ELSE '其他' END AS device", "1")
ORACLE["kpi_by_network"] = _kpi(
    "CASE WHEN networkmannername = '未知' THEN '其他' ELSE networkmannername END AS network", "1")
ORACLE["kpi_by_carrier"] = _kpi("CASE WHEN ispname = '未知' THEN '其他' ELSE ispname END AS carrier", "1")
ORACLE["kpi_by_channel"] = _kpi("coalesce(adplatformproviderid, 0) AS channel", "1")
ORACLE["city_count"] = (f"WITH {ADLOG}\nSELECT provincename, cityname, count(*) AS ct FROM adlog "
                        "GROUP BY provincename, cityname")
ORACLE["kpi_by_app"] = _kpi(f"{APP_REPORT} AS app", "1", "adlog a LEFT JOIN appdict_r d ON a.appid = d.appid",
                            f"{ADLOG}, {APPDICT_R}")
ORACLE["resolve_app_name"] = (f"WITH {ADLOG}, {APPDICT_R} SELECT a.sessionid, {APP_REPORT} AS app "
                              "FROM adlog a LEFT JOIN appdict_r d ON a.appid = d.appid")

# ingest
ORACLE["raw_log_parse"] = (f"WITH {RAW} SELECT CAST(len(f) AS INTEGER) AS n_fields, f[1] AS f_sessionid, f[23] AS f_long, "
                           "f[81] AS f_keywords, f[85] AS f_last FROM fields WHERE len(f) >= 85")
ORACLE["raw_log_typed"] = f"WITH {RAW} SELECT {_typed_select()} FROM fields WHERE len(f) >= 85"
ORACLE["log_roundtrip"] = f"WITH {ADLOG} SELECT * FROM adlog"
ORACLE["app_dict_dim"] = f"WITH {APPDICT_R} SELECT appid, appname_dict FROM appdict_r"
ORACLE["app_dict_dim_tags"] = f"WITH {APPDICT_T} SELECT appid, appname_dict FROM appdict_t"
ORACLE["lenient_int_cast"] = (
    f"WITH {RAW} SELECT f[1] AS f_sessionid, f[2] AS raw, {lenient_int('f[2]')} AS as_int, "
    f"{lenient_int('f[10]')} AS price_as_int, {lenient_int('f[9]')} AS mode_as_int FROM fields WHERE len(f) >= 85")
ORACLE["lenient_double_cast"] = (
    f"WITH {RAW} SELECT f[1] AS f_sessionid, f[10] AS raw, {lenient_double('f[10]')} AS as_double, "
    f"{lenient_double('f[2]')} AS id_as_double, {lenient_double('f[24]')} AS lat_as_double "
    "FROM fields WHERE len(f) >= 85")
ORACLE["blank_filter"] = (
    f"WITH {ADLOG} SELECT sessionid, {blank('adspacetypename')} AS name_blank, {blank('appname')} AS app_blank, "
    f"{not_blank('imei')} AS has_imei FROM adlog WHERE {blank('adspacetypename')} OR {blank('appname')}")
ORACLE["log_perturb"] = _perturb_sql(7)

# sinks
ORACLE["city_count_json"] = (f"WITH {ADLOG} SELECT count(*) AS ct, NULLIF(provincename, '') AS provincename, "
                             "NULLIF(cityname, '') AS cityname FROM adlog GROUP BY provincename, cityname")
ORACLE["report_text_lines"] = (f"WITH kpi AS ({ORACLE['kpi_by_location']}) "
                               + _report_line(["provincename", "cityname"], "kpi"))
ORACLE["report_text_lines_app"] = f"WITH kpi AS ({ORACLE['kpi_by_app']}) " + _report_line(["app"], "kpi")

# geo
ORACLE["geo_box_filter"] = f"WITH {ADLOG} SELECT sessionid, long, lat FROM adlog WHERE {IN_BOX}"
ORACLE["geohash6_cells"] = (f"WITH {ADLOG} SELECT sessionid, {CELL} AS geohash6 FROM adlog WHERE {IN_BOX}")
ORACLE["regeo_parse"] = (f"WITH {ADLOG}, {GEO} SELECT geohash6, response, {parse_areas('response')} "
                         "AS business_areas FROM responses")
ORACLE["business_tags"] = f"WITH {TAG_CTES} SELECT sessionid, kind, tag FROM t_biz"
ORACLE["business_names_all"] = (
    f"WITH {ADLOG}, {GEO} SELECT a.sessionid, a.geohash6, g.business_areas FROM "
    f"(SELECT sessionid, {CELL_ALL} AS geohash6 FROM adlog) a LEFT JOIN geodim g ON a.geohash6 = g.geohash6")
ORACLE["missing_geo_cells"] = (
    f"WITH {ADLOG}, {GEO}, pts AS (SELECT {CELL} AS geohash6, {lenient_double('long')} AS lo, "
    f"{lenient_double('lat')} AS la FROM adlog WHERE {IN_BOX}) "
    "SELECT geohash6, p.lo AS long, p.la AS lat FROM (SELECT geohash6, min({'lo': lo, 'la': la}) AS p FROM pts "
    "WHERE geohash6 NOT IN (SELECT geohash6 FROM geodim) GROUP BY geohash6) m")

# tag families
for key, table in [("ad_tags", "t_ad"), ("app_tags", "t_app"), ("device_tags", "t_dev"),
                   ("location_tags", "t_loc"), ("keyword_tags", "t_kw")]:
    ORACLE[key] = f"WITH {TAG_CTES} SELECT sessionid, kind, tag FROM {table}"
ORACLE["row_tags_all"] = f"WITH {TAG_CTES} {_union(V1, 'sessionid, kind, tag')}"
for key, like in [("sql_row_tags", "row_tags_all"), ("sql_geohash_cells", "geohash6_cells"), ("sql_regeo_parse", "regeo_parse")]:
    ORACLE[key] = ORACLE[like]

# profiles
USER_WEIGHTS = (f"uw AS (SELECT user_key, kind, tag, CAST(count(*) AS BIGINT) AS weight "
                f"FROM ({_union(V1)}) t GROUP BY user_key, kind, tag), "
                "ut AS (SELECT user_key, tag, CAST(sum(weight) AS BIGINT) AS weight FROM uw GROUP BY user_key, tag)")
ORACLE["user_tag_weights"] = f"WITH {TAG_CTES}, {USER_WEIGHTS} SELECT * FROM uw"


def _rendered(chunk_size: int) -> str:
    return (f"WITH {TAG_CTES}, {USER_WEIGHTS}, ch AS ({_chunk('user_key', 'tag', 'ut', chunk_size)}) "
            "SELECT user_key, chunk, count(*) AS n_tags, "
            "string_agg('(' || tag || ',' || CAST(weight AS VARCHAR) || ')', ',' ORDER BY tag) AS tags "
            "FROM ch GROUP BY user_key, chunk")


ORACLE["profile_rendered"] = _rendered(10_000)
ORACLE["profile_rendered_chunked"] = _rendered(8)
ORACLE["profile_sink"] = (f"SELECT p.*, d.dt FROM ({_rendered(10_000)}) p, "
                          "(SELECT unnest(['20190921', '20190922']) AS dt) d")
ORACLE["profile_map_rows"] = (f"WITH {TAG_CTES}, {USER_WEIGHTS} "
                              f"SELECT user_key, chunk, tag, weight FROM ({_chunk('user_key', 'tag', 'ut')}) c")

# identity
ORACLE["user_key"] = f"WITH {ADLOG} SELECT sessionid, {USER_KEY} AS user_key FROM adlog"
ORACLE["all_ids"] = (
    f"WITH {ADLOG}, l AS (SELECT sessionid, {_ids_list()} AS idl FROM adlog) SELECT sessionid, "
    "array_to_string(list_filter(idl, lambda x, i: list_position(idl, x) = i), ',') AS ids FROM l")
ORACLE["identity_vertices"] = f"WITH {TAG_CTES} SELECT DISTINCT unnest(idl) AS id FROM base"
ORACLE["identity_edges"] = (f"WITH {TAG_CTES} SELECT DISTINCT idl[1] AS src, unnest(idl) AS dst FROM base "
                            "WHERE len(idl) > 0")
ORACLE["connected_components"] = f"WITH RECURSIVE {TAG_CTES}, {GRAPH} SELECT id, component FROM cc"
ORACLE["event_component"] = f"WITH RECURSIVE {TAG_CTES}, {GRAPH} SELECT sessionid, component FROM rowcomp"
ORACLE["component_profiles"] = (
    f"WITH RECURSIVE {TAG_CTES}, {GRAPH} SELECT component, kind, tag, "
    "CAST(sum(weight) AS BIGINT) AS weight FROM ("
    f"SELECT rc.component, t.kind, t.tag, 1 AS weight FROM ({_union(V2)}) t JOIN rowcomp rc USING (sessionid) "
    "UNION ALL SELECT component, 'id', id, 0 FROM cc) x GROUP BY component, kind, tag")


def _members(chunk_size: int) -> str:
    return (f"WITH RECURSIVE {TAG_CTES}, {GRAPH}, ch AS ({_chunk('component', 'id', 'cc', chunk_size)}) "
            "SELECT component, chunk, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS members "
            "FROM ch GROUP BY component, chunk")


ORACLE["component_members"] = _members(10_000)
ORACLE["component_members_chunked"] = _members(3)

# files, chains and hard inputs
ORACLE["etl_chain"] = ORACLE["raw_log_typed"]
ORACLE["app_dict_file"] = ORACLE["app_dict_dim"]
ORACLE["stopwords_file"] = ORACLE["keyword_tags"]
ORACLE["custom_family_tags"] = (
    f"WITH {TAG_CTES} SELECT sessionid, 'custom' AS kind, 'HX' || CAST(length(sessionid) AS VARCHAR) || '_' || "
    "coalesce(ispname, '-') AS tag FROM adlog UNION ALL SELECT sessionid, kind, tag FROM t_loc")
ORACLE["kpi_dirty_amounts"] = (
    f"WITH {ADLOG}, dirty AS (SELECT * REPLACE ({D.dirty_price_expr()} AS winprice) FROM adlog), "
    f"k AS (SELECT provincename, cityname,{KPI_SELECT} FROM dirty GROUP BY provincename, cityname), "
    "c AS (SELECT *, CASE WHEN isnan(win_price_k) THEN 'nan' WHEN isinf(win_price_k) THEN 'infinite' "
    "ELSE 'finite' END AS price_kind FROM k) "
    "SELECT * REPLACE (CASE WHEN price_kind = 'finite' THEN win_price_k END AS win_price_k) FROM c")
# A chain's component is the smallest scrambled id of its block of 500 events.
ORACLE["identity_chain_components"] = (
    "WITH v AS (SELECT event_id // 500 AS block, event_id * 48271 % 2147483647 AS id FROM events "
    "UNION SELECT event_id // 500, (event_id + CASE WHEN event_id % 500 = 499 THEN 0 ELSE 1 END) * 48271 % 2147483647 "
    "FROM events) SELECT id, min(id) OVER (PARTITION BY block) AS component FROM v")
ORACLE["geo_dim_upsert"] = (
    f"WITH {ADLOG}, {GEO}, fetched AS (SELECT geohash6, at2 AS seq, {D.new_response_expr('geohash6', 'at2')} AS response "
    "FROM geo_cells, (SELECT unnest([1, 2]) AS at2) n), "
    f"parsed AS (SELECT geohash6, seq, {parse_areas('response')} AS areas FROM fetched WHERE response IS NOT NULL), "
    "fresh AS (SELECT geohash6, arg_max(areas, seq) AS areas FROM parsed WHERE areas <> '' GROUP BY geohash6) "
    "SELECT geohash6, areas AS business_areas FROM fresh UNION ALL "
    "SELECT geohash6, business_areas FROM geodim WHERE geohash6 NOT IN (SELECT geohash6 FROM fresh)")

# kept up to date
_N = "CAST(substr(sessionid, 2) AS BIGINT)"
_DAYS = ("dayedges AS (SELECT DISTINCT CAST(n % 3 AS INTEGER) + 1 AS d, idl[1] AS src, unnest(idl) AS dst FROM "
         f"(SELECT idl, {_N} AS n FROM base WHERE len(idl) > 0) x), "
         "days AS (SELECT unnest([1, 2, 3]) AS day), "
         "dund AS (SELECT DISTINCT day, src AS a, dst AS b FROM days JOIN dayedges ON d <= day "
         "UNION SELECT DISTINCT day, dst, src FROM days JOIN dayedges ON d <= day), "
         "dreach(day, id, root) AS (SELECT day, a, a FROM dund UNION SELECT dund.day, dund.b, dreach.root FROM dreach "
         "JOIN dund ON dund.a = dreach.id AND dund.day = dreach.day WHERE dreach.root < dund.b), "
         "dcc AS (SELECT day, id, min(root) AS component FROM dreach GROUP BY day, id)")
ORACLE["components_incremental"] = (f"WITH RECURSIVE {TAG_CTES}, {_DAYS} SELECT CAST(day AS INTEGER) AS day, id, component "
                                    "FROM dcc")
ORACLE["component_renames"] = (
    f"WITH RECURSIVE {TAG_CTES}, {_DAYS} SELECT DISTINCT o.component AS former, n.component FROM dcc o JOIN dcc n "
    "ON o.component = n.id WHERE o.day = 2 AND n.day = 3 AND o.component <> n.component")
ORACLE["profile_store_replaced"] = (
    f"WITH {TAG_CTES}, times AS (SELECT sessionid, CASE WHEN {_N} % 3 = 1 THEN CASE WHEN {_N} % 5 <> 0 THEN 1 ELSE 0 END "
    f"WHEN {_N} % 21 = 0 THEN 2 ELSE 1 END AS n FROM adlog) "
    f"SELECT user_key, kind, tag, CAST(sum(n) AS BIGINT) AS weight FROM ({_union(V1)}) t JOIN times USING (sessionid) "
    "GROUP BY user_key, kind, tag HAVING sum(n) > 0")

# hub ids
_REPLACED = ", ".join(f"{e} AS {c}" for c, e in D.placeholder_exprs().items())
_PLANTED = TAG_CTES.replace(ADLOG, ADLOG.replace("adlog AS", "plainlog AS", 1)
                            + f", adlog AS (SELECT * REPLACE ({_REPLACED}) FROM plainlog)", 1)
_HUBS = (f"{_PLANTED}, cooc AS (SELECT DISTINCT a AS id, b AS other FROM (SELECT a, unnest(idl) AS b FROM "
         "(SELECT idl, unnest(idl) AS a FROM base) x) y WHERE a <> b), "
         "hubs AS (SELECT id, substr(id, 1, 2) AS kind, count(*) AS degree FROM cooc GROUP BY id HAVING count(*) >= 40), "
         "hublist AS (SELECT coalesce(list(id), []) AS h FROM hubs), "
         "kept AS (SELECT base.* REPLACE (list_filter(idl, lambda x: NOT list_contains(h, x)) AS idl) FROM base, hublist)")
_KEPT = GRAPH.replace("FROM base ", "FROM kept ")
ORACLE["hub_ids"] = f"WITH {_HUBS} SELECT id, kind, degree FROM hubs"
ORACLE["components_without_hubs"] = f"WITH RECURSIVE {_HUBS}, {_KEPT} SELECT id, component FROM cc"
ORACLE["component_profiles_without_hubs"] = ORACLE["component_profiles"].replace(TAG_CTES, _HUBS).replace(GRAPH, _KEPT)

# reports by day
_PRICE_KIND = ("SELECT * REPLACE (CASE WHEN price_kind = 'finite' THEN win_price_k END AS win_price_k) FROM "
               "(SELECT *, CASE WHEN isnan(win_price_k) THEN 'nan' WHEN isinf(win_price_k) THEN 'infinite' "
               "ELSE 'finite' END AS price_kind FROM k) c")
ORACLE["report_store_location"] = (
    f"WITH {ADLOG}, dirty AS (SELECT * REPLACE ({D.dirty_price_expr()} AS winprice) FROM adlog), "
    f"counted AS (SELECT * FROM dirty WHERE {_N} % 3 <> 1 OR {_N} % 5 <> 0 UNION ALL SELECT * FROM dirty WHERE {_N} % 21 = 0), "
    f"k AS (SELECT provincename, cityname,{KPI_SELECT} FROM counted GROUP BY provincename, cityname) {_PRICE_KIND}")
ORACLE["report_store_days"] = (
    f"WITH {ADLOG} SELECT provincename, cityname, count(*) AS ct FROM (SELECT provincename, cityname FROM adlog "
    f"WHERE {_N} % 3 = 2 OR ({_N} % 3 = 1 AND {_N} % 5 <> 0) UNION ALL SELECT provincename, cityname FROM adlog "
    f"WHERE {_N} % 21 = 0) x GROUP BY provincename, cityname")

# clustered log
ORACLE["clustered_user_weights"] = ORACLE["user_tag_weights"]
ORACLE["clustered_event_component"] = ORACLE["event_component"]

# rejected lines
_BROKEN = (f"raw AS ({D.broken_line_sql('events')}), fields AS (SELECT string_split(value, ',') AS f, value FROM raw)")
ORACLE["raw_log_rejects"] = (
    f"WITH {_BROKEN} SELECT CASE WHEN trim(value) = '' THEN 'blank' WHEN len(f) = 1 THEN 'no_fields' ELSE 'few_fields' END "
    "AS verdict, value AS line, CAST(len(f) AS INTEGER) AS n_fields, true AS has_file, true AS has_block "
    "FROM fields WHERE len(f) < 85")
ORACLE["raw_log_accepted"] = f"WITH {_BROKEN} SELECT {_typed_select()} FROM fields WHERE len(f) >= 85"

# worklist and near cells
ORACLE["geo_worklist_stream"] = (f"WITH {ADLOG}, {GEO} SELECT geohash6 FROM geo_cells WHERE geohash6 NOT IN "
                                 "(SELECT geohash6 FROM geodim)")
_LON = f"CAST(floor(({lenient_double('long')} + 180.0) / 360.0 * 32768.0) AS BIGINT)"
_LAT = f"CAST(floor(({lenient_double('lat')} + 90.0) / 180.0 * 32768.0) AS BIGINT)"
ORACLE["business_near"] = (
    f"WITH {ADLOG}, {GEO}, moved AS (SELECT {', '.join(f'{e} AS {c}' for c, e in D.drift_exprs().items())} FROM adlog), "
    f"pos AS (SELECT DISTINCT {CELL} AS geohash6, {_LON} AS x, {_LAT} AS y FROM moved WHERE {IN_BOX}), "
    f"known AS (SELECT DISTINCT {CELL} AS geohash6, {_LON} AS x, {_LAT} AS y FROM adlog WHERE {IN_BOX}), "
    "held AS (SELECT known.*, business_areas FROM known JOIN geodim USING (geohash6)), "
    "met AS (SELECT p.geohash6, h.geohash6 AS near, CAST(greatest(abs(p.x - h.x), abs(p.y - h.y)) AS INTEGER) AS ring, "
    "(p.x - h.x) ** 2 + (p.y - h.y) ** 2 AS steps, h.business_areas FROM pos p JOIN held h "
    "ON h.x BETWEEN p.x - 2 AND p.x + 2 AND h.y BETWEEN p.y - 2 AND p.y + 2) "
    "SELECT geohash6, near, ring, business_areas FROM met "
    "QUALIFY row_number() OVER (PARTITION BY geohash6 ORDER BY ring, steps, near) = 1")

# heaviest tags
for key, groups, most in [("user_top_tags", "user_key", 5), ("user_top_tags_by_kind", "user_key, kind", 2)]:
    ORACLE[key] = (f"WITH {TAG_CTES}, {USER_WEIGHTS} SELECT user_key, kind, tag, weight, CAST(row_number() OVER "
                   f"(PARTITION BY {groups} ORDER BY weight DESC, kind, tag) AS INTEGER) AS rank FROM uw QUALIFY rank <= {most}")
