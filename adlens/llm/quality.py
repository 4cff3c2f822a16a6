"""Quality rules as a bitmask ledger.

``measure`` evaluates every rule exactly once per document and stores the measurements and
one bit per failed rule. Policies are named masks over those bits: applying another version,
or asking what a rule costs, reads the ledger and never the texts again. Everything is built
from DataFrame functions; a document's arrays never leave its row and no step shuffles texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import SPACES, Positional, pick, stored, strip_spaces, words_of

SYMBOLS = "#*$%&|<>"
# FIXED VALUES: code points of scripts written without spaces between words, as ranges of a character class:
# Thai and Lao, Myanmar, Khmer, CJK punctuation and kana, Han, compatibility ideographs, full- and half-width forms.
UNSPACED = "[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3000-\u30FF\u31F0-\u31FF\u3400-\u9FFF\uF900-\uFAFF\uFF00-\uFFEF\U00020000-\U0003FFFF]"


@dataclass(frozen=True)
class Rule:
    """``failed`` is SQL over the measurements; ``bit`` is fixed for ever, as ledgers store it."""
    name: str
    bit: int
    failed: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


RULES = (
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words"),
    Rule("duplicate_lines", 3, "2 * n_dup_lines > n_lines"),
    Rule("short_words", 4, "word_chars < 2 * n_words"),
    Rule("long_words", 5, "word_chars > 20 * n_words"),
    # As long_words, over the characters of spaced scripts only: a clean Chinese or Thai text has no such words.
    Rule("long_spaced_words", 6, "word_chars - unspaced_chars > 20 * n_words"),
)
BASE = ("few_words", "repeated_windows")

# A released version is never edited; a new opinion is a new version.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "duplicate_lines"),
    "v3": (*BASE, "symbols", "duplicate_lines", "short_words", "long_words"),
    "v4": (*BASE, "symbols", "duplicate_lines", "short_words", "long_spaced_words"),
}
CURRENT = "v4"
MEASURES = ("n_words", "word_chars", "unspaced_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def mask_of(rules: tuple[str, ...] | list[str]) -> int:
    by_name = {r.name: r.mask for r in RULES}
    return sum(by_name[name] for name in rules)


def _repeat_words(words: str) -> tuple[dict[str, Column], ...]:
    """Projections, one on top of the other, that end in ``n_repeat_words``.

    Windows are compared by 64-bit hash inside one document: sort (hash, position), keep
    neighbours with equal hashes, and count the words their windows cover.
    """
    n = F.size(words)
    follows = F.arrays_zip(F.slice(words, 1, F.greatest(n - 2, F.lit(0))).alias("a"),
                           F.slice(words, 2, F.greatest(n - 2, F.lit(0))).alias("b"),
                           F.slice(words, 3, F.greatest(n - 2, F.lit(0))).alias("c"))
    windows = F.transform(follows, lambda w, i: F.struct(
        F.xxhash64(w["a"], w["b"], w["c"]).alias("h"), i.alias("p")))
    m = F.greatest(F.size("_windows") - 1, F.lit(0))
    pairs = F.filter(F.arrays_zip(F.slice("_windows", 1, m).alias("x"), F.slice("_windows", 2, m).alias("y")),
                     lambda z: z["x"]["h"] == z["y"]["h"])
    at = F.sort_array(F.array_distinct(F.flatten(F.transform(
        pairs, lambda z: F.array(z["x"]["p"], z["y"]["p"])))))
    k = F.size("_at")
    covered = F.when(k == 0, F.lit(0)).otherwise(F.aggregate(
        F.zip_with(F.slice("_at", 1, F.greatest(k - 1, F.lit(0))), F.slice("_at", 2, F.greatest(k - 1, F.lit(0))),
                   lambda a, b: F.least(F.lit(3), b - a)),
        F.lit(3), lambda s, x: s + x))
    return ({"_windows": F.sort_array(windows)}, {"_at": at}, {"n_repeat_words": covered.cast("long")})


def with_measures(frame: DataFrame, text: str) -> DataFrame:
    """``frame`` plus MEASURES and ``fail_bits`` of the column ``text``; helper columns start with ``_q``."""
    t = F.coalesce(F.col(text), F.lit(""))
    frame = frame.withColumns({"_q_words": words_of(t), "_q_lines": F.filter(
        F.split(t, "\n", -1), lambda line: strip_spaces(line) != "")})
    frame = frame.withColumns({
        "n_words": F.size("_q_words").cast("long"),
        "word_chars": F.char_length(F.translate(t, SPACES, "")).cast("long"),
        "unspaced_chars": (F.char_length(t) - F.char_length(F.regexp_replace(t, F.lit(UNSPACED), F.lit("")))).cast("long"),
        "n_symbols": (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size("_q_lines").cast("long"),
        "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
    })
    for step in _repeat_words("_q_words"):
        frame = frame.withColumns(step)
    # The sign bit of a row number is 0. Its being there keeps the optimizer from pushing filters on
    # the bits below this projection, where every mention of a measurement would compute it again.
    bits = F.shiftrightunsigned(F.monotonically_increasing_id(), 63)
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.failed), F.lit(rule.mask)).otherwise(F.lit(0)).cast("long"))
    return frame.withColumn("fail_bits", bits).drop("_q_words", "_q_lines", "_windows", "_at")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger: ``doc_id``, MEASURES and ``fail_bits``, one row per input row.

    A null or empty text has no words and no lines. Repeated rows and null ids give one row
    each; an empty table gives an empty ledger; extra columns are ignored.
    """
    return with_measures(pick(docs, doc_id=id_col, _q_text=text_col), "_q_text").select(
        "doc_id", *MEASURES, "fail_bits")


def failed(mask: int, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask).cast("long")) != 0


def apply_policy(ledger: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger plus ``base_failed`` and ``kept`` under a policy version."""
    base, mask = mask_of(BASE), mask_of(POLICIES[version])
    return ledger.withColumns({"base_failed": failed(base), "kept": ~failed(base | mask)})


def ablation(ledger: DataFrame, version: str = CURRENT) -> DataFrame:
    """``rule, failing, only_this, kept_without`` per rule of the policy.

    Documents are first counted per failure mask (at most 2 ** rules rows, whatever the
    input), then bit tests on those few masks answer every question. Repeated rows and null ids
    count as often as they occur; an empty ledger gives no rows; extra columns are ignored.
    """
    mask = mask_of(POLICIES[version])
    masks = (ledger.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits"))
                   .agg(F.count(F.lit(1)).alias("n")))
    rules = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("bit"))
                                for r in RULES if r.mask & mask]))
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit")))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    n = F.col("n")
    return masks.select("bits", "n", rules.alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit, n).otherwise(0)).alias("failing"),
        F.sum(F.when(hit & (rest == 0), n).otherwise(0)).alias("only_this"),
        F.sum(F.when(rest == 0, n).otherwise(0)).alias("kept_without"))


def keep_good(docs: DataFrame, version: str = CURRENT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the policy, with their own columns unchanged.

    A null or empty text has no words and goes; a text of any length is measured whole. Repeated rows
    are judged alike and all stay or all go; there are no ties. An empty table gives an empty table;
    extra columns, whatever their names, are handed through by position.
    """
    p = Positional(docs)
    ledger = with_measures(p.frame, p[text_col])
    return p.restore(ledger.filter(~failed(mask_of(BASE) | mask_of(POLICIES[version]))))


def compare(ledger: DataFrame, version: str = CURRENT, earlier: str = "v3") -> DataFrame:
    """The ledger under two policy versions, with the ablation of the first beside each document.

    Adds ``base_failed``, ``kept``, ``kept_before`` (verdict of ``earlier``), ``sole_rule`` (the rule of
    ``version`` that alone rejects the document, else '') and of that rule, from ``ablation``, ``sole_rule_failing``
    (documents that fail it) and ``kept_without`` (documents kept if it were left out), both 0 without such a rule.
    Everything is read from the ledger; the joined table has one row per rule. An empty ledger gives an empty result.
    """
    mask = mask_of(POLICIES[version])
    before = apply_policy(ledger, earlier).withColumnRenamed("kept", "kept_before").drop("base_failed")
    sole = F.create_map(*[x for r in RULES if r.mask & mask for x in (F.lit(r.mask).cast("long"), F.lit(r.name))])
    judged = apply_policy(before, version).withColumn("sole_rule", F.coalesce(
        F.try_element_at(sole, F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long"))), F.lit("")))
    # At most one row per rule, whatever the input.
    effects = ablation(ledger, version).select(F.col("rule").alias("sole_rule"),
                                               F.col("failing").alias("sole_rule_failing"), "kept_without")
    return judged.join(F.broadcast(effects), "sole_rule", "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in ("sole_rule_failing", "kept_without")})


def op8(docs: DataFrame) -> DataFrame:
    """The ledger of ``docs``, stored once; both policy versions and the ablation read it, never the texts."""
    return compare(stored(measure(docs), "quality-ledger")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "fail_bits", "unspaced_chars", "kept_before", "sole_rule", "sole_rule_failing", "kept_without")


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
p AS (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram FROM p),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT i + k) AS covered FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
m AS (SELECT doc_id, len(ws) AS n_words,
             CAST(coalesce(list_sum([length(x) FOR x IN ws]), 0) AS BIGINT) AS word_chars,
             length(t) - length(regexp_replace(t, 'UNSPACED', '', 'g')) AS unspaced_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             coalesce(covered, 0) AS n_repeat_words
      FROM w LEFT JOIN c USING (rid)),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
             + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
             + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
             + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
             + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
             + (CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END)
             + (CASE WHEN word_chars - unspaced_chars > 20 * n_words THEN 64 ELSE 0 END) AS fail_bits FROM m),
v AS (SELECT *, fail_bits & 95 AS bits FROM b),
rules(bit, sole_rule) AS (VALUES (1, 'few_words'), (2, 'repeated_windows'), (4, 'symbols'), (8, 'duplicate_lines'),
                                 (16, 'short_words'), (64, 'long_spaced_words')),
a AS (SELECT bit, sole_rule, count(*) FILTER (bits & bit <> 0) AS sole_rule_failing,
             count(*) FILTER (bits & ~bit = 0) AS kept_without FROM rules, v GROUP BY bit, sole_rule)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, bits = 0 AS kept, CAST(fail_bits AS BIGINT) AS fail_bits,
       CAST(unspaced_chars AS BIGINT) AS unspaced_chars, (fail_bits & 63) = 0 AS kept_before,
       coalesce(sole_rule, '') AS sole_rule, coalesce(sole_rule_failing, 0) AS sole_rule_failing,
       coalesce(kept_without, 0) AS kept_without
FROM v LEFT JOIN a ON bits = bit
""".replace("UNSPACED", UNSPACED)
