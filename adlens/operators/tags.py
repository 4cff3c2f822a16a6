"""Tag families (T1-T7) and the family registry.

Each family turns a log row into zero or more ``(kind, tag)`` entries with weight 1. A
family is a function ``(df, ctx) -> (df, Column)``: it may add columns to ``df`` (through a
dimension join) and returns an ``array<struct<kind, tag>>`` Column. ``row_tags`` builds all
requested families in one pass over the log, concatenates the arrays and explodes once, so
the log is scanned a single time however many families are asked for. Users add a family
with ``register_family``.

Stop words given as a Python list are filtered inside the array (an ``InSet`` lookup in
generated code); given as a DataFrame they are removed after the explode with a left-anti
join that is broadcast behind a size check.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens import schema as S
from adlens.functions.scalar import int_or_zero, is_blank, not_blank, prefixed, utf16_length_between
from adlens.operators.dimensions import app_name_column, join_dimension
from adlens.operators.geo import business_names, lookup_business

TAG_TYPE = "array<struct<kind:string,tag:string>>"


@dataclass
class TagContext:
    app_dict: DataFrame | None = None          # (appid, appname_dict), unique on appid
    stop_words: list[str] | DataFrame = field(default_factory=lambda: list(S.DEFAULT_STOP_WORDS))
    geo_dim: DataFrame | None = None           # (geohash6, business_areas)
    ad_name_mode: str = "blank"                # 'blank' (as the platform does) or 'present'
    business_box_filter: bool = True
    max_broadcast_rows: int | None = None

    def join_kw(self) -> dict:
        return {} if self.max_broadcast_rows is None else {"max_broadcast_rows": self.max_broadcast_rows}


def _entry(kind: str, tag: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), tag.alias("tag"))


def _entries(kind: str, texts: list[Column]) -> list[Column]:
    return [F.when(t.isNotNull(), _entry(kind, t)) for t in texts]


def _compact(*entries: Column) -> Column:
    """Array of the non-null entries (an entry is null when its condition fails)."""
    return F.filter(F.array(*entries), lambda x: x.isNotNull())


def _empty() -> Column:
    return F.array().cast(TAG_TYPE)


# --- T1 ad ------------------------------------------------------------------------
def _ad_texts(space_type: Column, space_name: Column, channel: Column, name_mode: str = "blank") -> list[Column]:
    st = int_or_zero(space_type)
    lc = (F.when(st > 9, prefixed(S.TAG_PREFIX_AD_SPACE, st))
            .when(st > 0, F.concat(F.lit(S.TAG_PREFIX_AD_SPACE + "0"), st.cast("string"))))
    name_cond = is_blank(space_name) if name_mode == "blank" else not_blank(space_name)
    ln = F.when(name_cond, prefixed(S.TAG_PREFIX_AD_NAME, space_name))
    return [lc, ln, prefixed(S.TAG_PREFIX_CHANNEL, int_or_zero(channel))]


def ad_tag_array(space_type: Column, space_name: Column, channel: Column,
                 name_mode: str = "blank") -> Column:
    return _compact(*_entries("ad", _ad_texts(space_type, space_name, channel, name_mode)))


def _texts_ad(df, ctx):
    return df, F.array(*_ad_texts(F.col("adspacetype"), F.col("adspacetypename"),
                                  F.col("adplatformproviderid"), ctx.ad_name_mode))


def _family_ad(df, ctx):
    return df, ad_tag_array(F.col("adspacetype"), F.col("adspacetypename"),
                            F.col("adplatformproviderid"), ctx.ad_name_mode)


# --- T2 app ------------------------------------------------------------------------
def _texts_app(df, ctx):
    if ctx.app_dict is None:
        name = F.when(is_blank("appname"), F.lit(S.OTHER)).otherwise(F.col("appname"))
    else:
        d = ctx.app_dict.select(F.col("appid").alias("__app_key"), F.col("appname_dict").alias("__app_name"))
        df = join_dimension(df, d, F.col("appid") == F.col("__app_key"), "left", **ctx.join_kw())
        name = app_name_column(F.col("appname"), F.col("__app_name"), S.OTHER)
    return df, F.array(F.concat(F.lit(S.TAG_PREFIX_APP), name))


def _family_app(df, ctx):
    df, texts = _texts_app(df, ctx)
    return df, F.array(_entry("app", texts[0]))


# --- T3 device ------------------------------------------------------------------------
def _code_tag(c: Column, codes: dict, default: str) -> Column:
    out = None
    for k, v in codes.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def _device_texts(client: Column, network: Column, carrier: Column) -> list[Column]:
    return [_code_tag(int_or_zero(client), S.OS_TAGS, S.OS_TAG_DEFAULT),
            _code_tag(network, S.NETWORK_TAGS, S.NETWORK_TAG_DEFAULT),
            _code_tag(carrier, S.CARRIER_TAGS, S.CARRIER_TAG_DEFAULT)]


def device_tag_array(client: Column, network: Column, carrier: Column) -> Column:
    return F.array(*[_entry("device", t) for t in _device_texts(client, network, carrier)])


def _texts_device(df, ctx):
    return df, F.array(*_device_texts(F.col("client"), F.col("networkmannername"), F.col("ispname")))


def _family_device(df, ctx):
    return df, device_tag_array(F.col("client"), F.col("networkmannername"), F.col("ispname"))


# --- T4 location --------------------------------------------------------------------------
def _location_texts(province: Column, city: Column) -> list[Column]:
    return [F.when(not_blank(province), F.concat(F.lit(S.TAG_PREFIX_PROVINCE), province)),
            F.when(not_blank(city), F.concat(F.lit(S.TAG_PREFIX_CITY), city))]


def location_tag_array(province: Column, city: Column) -> Column:
    return _compact(*_entries("location", _location_texts(province, city)))


def _texts_location(df, ctx):
    return df, F.array(*_location_texts(F.col("provincename"), F.col("cityname")))


def _family_location(df, ctx):
    return df, location_tag_array(F.col("provincename"), F.col("cityname"))


# --- T5 business ----------------------------------------------------------------------------
def _texts_business(df, ctx):
    if ctx.geo_dim is None:
        return df, F.array().cast("array<string>")
    df = lookup_business(df, ctx.geo_dim, ctx.business_box_filter, **ctx.join_kw())
    return df, business_names(F.col("business_areas"))


def _family_business(df, ctx):
    df, names = _texts_business(df, ctx)
    return df, F.transform(names, lambda n: _entry("business", n))


# --- T6 keyword ---------------------------------------------------------------------------------
def _words(keywords: Column) -> Column:
    return F.coalesce(F.split(keywords, r"\|", -1), F.array().cast("array<string>"))


def _is_keyword(word: Column, stop_words: list[str] | None) -> Column:
    right = utf16_length_between(word, S.KEYWORD_MIN_LEN, S.KEYWORD_MAX_LEN)
    return right & ~word.isin(list(dict.fromkeys(stop_words))) if stop_words else right


def keyword_tag_array(keywords: Column, stop_words: list[str] | None = None) -> Column:
    kept = F.filter(_words(keywords), lambda w: _is_keyword(w, stop_words))
    return F.transform(kept, lambda w: _entry("keyword", F.concat(F.lit(S.TAG_PREFIX_KEYWORD), w)))


def _texts_keyword(df, ctx):
    """All words; ``row_tags`` drops those that are no keywords, and prefixes the others."""
    return df, _words(F.col("keywords"))


def _family_keyword(df, ctx):
    stop = ctx.stop_words if isinstance(ctx.stop_words, list) else None
    return df, keyword_tag_array(F.col("keywords"), stop)


# --- registry -----------------------------------------------------------------------------------
Family = Callable[[DataFrame, TagContext], tuple[DataFrame, Column]]
FAMILIES: dict[str, Family] = {
    "ad": _family_ad,
    "app": _family_app,
    "business": _family_business,
    "device": _family_device,
    "location": _family_location,
    "keyword": _family_keyword,
}
# The built-in families as arrays of plain texts (null: no tag), which need no function per array item.
TEXTS: dict[Family, Family] = {_family_ad: _texts_ad, _family_app: _texts_app, _family_business: _texts_business,
                               _family_device: _texts_device, _family_location: _texts_location,
                               _family_keyword: _texts_keyword}
KIND_OF = {fn: kind for kind, fn in FAMILIES.items()}
# Family order of the two profile jobs: v1 includes business areas, v2 leaves them out.
FAMILIES_V1 = ["ad", "app", "business", "device", "location", "keyword"]
FAMILIES_V2 = ["ad", "app", "device", "location", "keyword"]


def register_family(name: str, fn: Family) -> None:
    FAMILIES[name] = fn


def row_tag_array(df: DataFrame, families: list[str], ctx: TagContext,
                  out_col: str = "tags") -> DataFrame:
    """``df`` plus one ``array<struct<kind, tag>>`` with all families concatenated."""
    arrays = []
    for name in families:
        df, arr = FAMILIES[name](df, ctx)
        arrays.append(F.coalesce(arr.cast(TAG_TYPE), _empty()))
    return df.withColumn(out_col, F.concat(*arrays) if len(arrays) > 1 else arrays[0])


def _text_tags(df: DataFrame, families: list[str], ctx: TagContext, keys: list[str]) -> DataFrame:
    groups = []
    for name in families:
        fn = FAMILIES[name]
        df, texts = TEXTS[fn](df, ctx)
        groups.append((KIND_OF[fn], texts))
    df = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), texts.alias("texts")) for k, texts in groups])).alias("__g"))
    long = df.select(*keys, F.col("__g.kind").alias("kind"), F.explode("__g.texts").alias("tag"))
    stop = ctx.stop_words if isinstance(ctx.stop_words, list) else None
    tag, is_word = F.col("tag"), F.col("kind") == "keyword"
    long = long.filter(tag.isNotNull() & (~is_word | _is_keyword(tag, stop)))
    return long.withColumn("tag", F.when(is_word, F.concat(F.lit(S.TAG_PREFIX_KEYWORD), tag)).otherwise(tag))


def row_tags(df: DataFrame, families: list[str], ctx: TagContext, keys: list[str]) -> DataFrame:
    """Long form ``(keys..., kind, tag)``: one row per tag occurrence (weight 1 each).

    Built-in families alone are exploded as plain texts, by family and then by text, and words are looked at
    after that, in generated code. With another family among them, all come as arrays of tags.
    """
    if all(FAMILIES[name] in TEXTS for name in families):
        long = _text_tags(df, families, ctx, keys)
    else:
        tagged = row_tag_array(df, families, ctx, "__tags")
        long = tagged.select(*keys, F.explode("__tags").alias("__t")).select(
            *keys, F.col("__t.kind").alias("kind"), F.col("__t.tag").alias("tag"))
    if "keyword" in families and isinstance(ctx.stop_words, DataFrame):
        stop = ctx.stop_words.select(F.concat(F.lit(S.TAG_PREFIX_KEYWORD), F.col("word")).alias("__stop"),
                                     F.lit("keyword").alias("__stop_kind")).distinct()
        cond = (F.col("tag") == F.col("__stop")) & (F.col("kind") == F.col("__stop_kind"))
        long = join_dimension(long, stop, cond, "left_anti", **ctx.join_kw())
    return long
