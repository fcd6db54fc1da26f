"""Quality rules: divergence of a text's histograms from its language's.

For every language with a list of common words the reference is the sum, over
the different texts marked with that language that pass the base rules, of two
histograms: character classes, and common words against all other words; so
neither junk nor copies of one text move it.  A document is rejected when the
Jensen-Shannon distance (base 2, 0 to 1) to its reference exceeds a bound, with
a separate bound per histogram.  Below the minimum length a histogram is noise
and isn't judged.  Only DataFrame functions are used.  One pass over the texts
leaves a narrow table of counts; references and verdicts are made from that.

Defined cases: a null text is empty and has no words (it fails the base rule);
a null or unlisted language has no reference, so only the base rule applies;
repeated rows are judged alike; columns beyond doc_id, text and lang aren't
read.  Windows are compared by their 64-bit hash within one text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_PATTERN, materialize, read_table, text_or_empty, without_rows, words_of

#: Frequent function words; the reference frequencies come from the corpus.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "this"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "sur"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "para", "es"],
}
WINDOW = 5


@dataclass(frozen=True)
class Bounds:
    min_words: int = 10
    max_repeat_percent: int = 20
    #: Guards: shorter texts aren't judged by the histogram.
    min_chars_judged: int = 200
    min_words_judged: int = 60
    max_char_distance: float = 0.33
    max_word_distance: float = 0.305


#: Character classes in the order in which they are taken out of the words.
CHAR_CLASSES = {"lower": "a-z", "upper": "A-Z", "symbol": "#*$%&|<>", "digit": "0-9", "punct": "!-~"}


def char_counts(joined: Column) -> list[Column]:
    """A count per class of CHAR_CLASSES, then ``c_other``; each is taken from what the classes before it leave."""
    out, left = [], joined
    for name, chars in CHAR_CLASSES.items():
        rest = F.regexp_replace(left, f"[{chars}]+", "")
        out.append((F.length(left) - F.length(rest)).cast("long").alias(f"c_{name}"))
        left = rest
    return [*out, F.length(left).cast("long").alias("c_other")]


def common_words(lang: Column) -> Column:
    """The row's language's list as an array; null without one."""
    listed = F.when(F.lit(False), F.array().cast("array<string>"))
    for name, words in COMMON_WORDS.items():
        listed = listed.when(lang == name, F.array(*map(F.lit, words)))
    return listed


def features(docs: DataFrame) -> DataFrame:
    """One narrow row per document: counts and histograms, without the text."""
    forms = sorted({f for ws in COMMON_WORDS.values() for w in ws for f in (w, w.capitalize(), w.upper())})
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD_PATTERN))
    df = docs.select("doc_id", "lang", text_or_empty().alias("text"))
    df = df.withColumns({"text_hash": F.xxhash64("text"), "words": words_of("text"), "_lines": lines})
    df = df.select(
        "doc_id", "lang", "text_hash", "words",
        F.size("words").cast("long").alias("n_words"),
        F.array_join("words", "").alias("_joined"),
        F.length("text").alias("_length"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform(F.filter("words", lambda w: w.isin(forms)), F.lower).alias("_found"),
    )
    df = df.select(
        "doc_id", "lang", "text_hash", "words", "n_words", "n_dup_lines",
        F.length("_joined").cast("long").alias("word_chars"),
        (F.col("_length") - F.length("_joined")).cast("long").alias("c_space"),
        *char_counts(F.col("_joined")),
        F.transform(common_words(F.col("lang")), lambda k: F.size(F.filter("_found", lambda w: w == k)).cast("long")).alias("common"),
    )
    return repeat_counts(df)


CLASS_COLUMNS = ["c_space", *(f"c_{k}" for k in CHAR_CLASSES), "c_other"]
N_COMMON = len(COMMON_WORDS["en"])


def base_failed(bounds: Bounds) -> Column:
    return (F.col("n_words") < bounds.min_words) | (100 * F.col("n_repeat_words") > bounds.max_repeat_percent * F.col("n_words"))


def references(hist: DataFrame, bounds: Bounds) -> DataFrame:
    """One row per listed language: the two reference histograms as shares, from texts that pass the base rules, each once."""
    common = [F.sum(F.get("common", F.lit(i))).alias(f"w_{i}") for i in range(N_COMMON)]
    sums = (
        hist.where(F.col("lang").isin(list(COMMON_WORDS)) & (F.col("n_words") > 0) & ~base_failed(bounds))
        .select("lang", "text_hash", *CLASS_COLUMNS, "common", "n_words")
        .distinct()
        .groupBy("lang")
        .agg(*(F.sum(c).alias(c) for c in CLASS_COLUMNS), *common, F.sum("n_words").alias("n_words"))
    )
    chars = reduce(lambda a, b: a + b, map(F.col, CLASS_COLUMNS))
    listed = reduce(lambda a, b: a + b, (F.col(f"w_{i}") for i in range(N_COMMON)))
    return sums.select(
        F.col("lang").alias("ref_lang"),
        F.array(*(F.col(c) / chars for c in CLASS_COLUMNS)).alias("ref_chars"),
        F.array(*(F.col(f"w_{i}") / F.col("n_words") for i in range(N_COMMON)), (F.col("n_words") - listed) / F.col("n_words")).alias("ref_words"),
    )


def js_distance(p: list[Column], q: list[Column]) -> Column:
    """Jensen-Shannon distance, the root of the divergence in base 2."""

    def half(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    total = reduce(lambda a, b: a + b, (half(a, b) + half(b, a) for a, b in zip(p, q, strict=True)))
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def repeat_counts(df: DataFrame) -> DataFrame:
    """``words`` becomes n_repeat_words: how many lie in a window found twice or more.

    Texts without such a window (most) end at the count of distinct hashes; in
    the others equal windows are brought together by a sort, never by pairs.
    """
    tail = lambda name, start: F.slice(name, start, F.greatest(F.size(name), F.lit(1)))
    pair = lambda a, b: F.xxhash64(a, b)
    df = df.withColumn("_w", F.transform("words", lambda w: F.xxhash64(w))).drop("words")
    df = df.withColumn("_2", F.zip_with("_w", tail("_w", 2), pair))
    df = df.withColumn("_4", F.zip_with("_2", tail("_2", 3), pair)).drop("_2")
    five = F.zip_with("_4", tail("_w", 5), pair)
    df = df.withColumn("_grams", F.slice(five, 1, F.greatest(F.size("_w") - (WINDOW - 1), F.lit(0)))).drop("_w", "_4")
    again = F.size(F.array_distinct("_grams")) < F.size("_grams")
    pairs = F.when(again, F.sort_array(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("_pairs", pairs).drop("_grams")
    near = lambda p, i, d: F.coalesce(F.get("_pairs", i + d)["h"] == p["h"], F.lit(False))
    hit = F.transform("_pairs", lambda p, i: F.when(near(p, i, -1) | near(p, i, 1), p["i"]))
    df = df.withColumn("_starts", F.sort_array(F.filter(hit, lambda s: s.isNotNull()))).drop("_pairs")
    spans = F.transform("_starts", lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", i + 1) - s, F.lit(WINDOW))).cast("long"))
    total = F.aggregate(spans, F.lit(0).cast("long"), lambda a, b: a + b)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("_starts")


def judge(docs: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """One row per document: counts, distances (null where not judged), base_failed and kept."""
    found = materialize(features(docs), "quality-features")
    refs = materialize(references(found, bounds), "quality-references")  # a row per listed language
    df = found.join(F.broadcast(refs), F.col("lang") == F.col("ref_lang"), "left")
    chars = reduce(lambda a, b: a + b, map(F.col, CLASS_COLUMNS))
    listed = F.aggregate("common", F.lit(0).cast("long"), lambda a, b: a + b)
    df = df.withColumns({"_chars": chars, "_rest": F.col("n_words") - listed})
    # A guarded histogram may have no characters or words at all, hence the floor of one.
    n_chars, n_words = F.greatest("_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    p_chars = [F.col(c) / n_chars for c in CLASS_COLUMNS]
    p_words = [*(F.get("common", F.lit(i)) / n_words for i in range(N_COMMON)), F.col("_rest") / n_words]
    char_d = js_distance(p_chars, [F.get("ref_chars", F.lit(i)) for i in range(len(p_chars))])
    word_d = js_distance(p_words, [F.get("ref_words", F.lit(i)) for i in range(len(p_words))])
    known = F.col("ref_lang").isNotNull()
    df = df.withColumns(
        {
            "base_failed": base_failed(bounds),
            "char_distance": F.when(known & (F.col("_chars") >= bounds.min_chars_judged), char_d),
            "word_distance": F.when(known & (F.col("n_words") >= bounds.min_words_judged), word_d),
        }
    )
    far = F.coalesce(F.col("char_distance") > bounds.max_char_distance, F.lit(False)) | F.coalesce(
        F.col("word_distance") > bounds.max_word_distance, F.lit(False)
    )
    return df.select(
        "doc_id", "n_words", "word_chars", F.col("c_symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance", "text_hash",
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that fail the rules go.

    The anti-join carries the ids of rejected documents with a hash of the text,
    so ids that occur twice with different texts are told apart.  Null and empty
    texts fail the rules and go; repeated rows stay or go together; other
    columns pass through, whatever their names; an empty table stays empty.
    """
    return without_rows(docs, judge(docs).where("NOT kept").select("doc_id", "text_hash"), F.xxhash64(text_or_empty()))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = judge(read_table(spark, sf_dir, "documents")).drop("text_hash")
    return df.withColumns({c: F.round(c, 6) for c in ("char_distance", "word_distance")})


def _sql(bounds: Bounds = Bounds()) -> str:
    """The same rows in SQL, for the lists and bounds of this module."""
    chars = [f"c{i}" for i in range(len(CLASS_COLUMNS))]
    listed = [f"w{i}" for i in range(N_COMMON)]
    taken, classes = [], list(CHAR_CLASSES.values())
    for i, c in enumerate(classes):
        taken.append(f"j{i} AS (SELECT *, length(r{i}) - length(r{i + 1}) AS c{i + 1} FROM (SELECT *, regexp_replace(r{i}, '[{c}]+', '', 'g') AS r{i + 1} FROM {f'j{i - 1}' if i else 'j'}) a)")
    forms = lambda w: ", ".join(f"'{f}'" for f in sorted({w, w.capitalize(), w.upper()}))
    counts = ", ".join(
        "CASE lang " + " ".join(f"WHEN '{k}' THEN len([w FOR w IN ws IF w IN ({forms(v[i])})])" for k, v in COMMON_WORDS.items()) + f" END AS w{i}" for i in range(N_COMMON)
    )
    half = lambda a, b: f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END"

    def distance(p: list[str], q: list[str]) -> str:
        return "sqrt(greatest((" + " + ".join(f"({half(a, b)}) + ({half(b, a)})" for a, b in zip(p, q, strict=True)) + ") / 2, 0))"

    all_chars, rest = " + ".join(chars), "n_words - (" + " + ".join(listed) + ")"
    p_chars, p_words = [f"(f.{c} * 1.0::DOUBLE / greatest(n_chars, 1))" for c in chars], [f"(f.{w} * 1.0::DOUBLE / greatest(n_words, 1))" for w in [*listed, "rest"]]
    return rf"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws, [l FOR l IN string_split(x, chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS ls FROM t),
j AS (SELECT *, array_to_string(ws, '') AS r0, length(x) - length(array_to_string(ws, '')) AS c0 FROM w),
{", ".join(taken)},
g AS (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w) a),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) a WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM rep) a GROUP BY 1),
f0 AS (SELECT j.doc_id, lang, md5(x) AS h, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(r0) AS BIGINT) AS word_chars, CAST(c3 AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
       coalesce(cov.n, 0) AS n_repeat_words, {", ".join(chars[:-1])}, length(r{len(classes)}) AS {chars[-1]}, {counts}
       FROM j{len(classes) - 1} j LEFT JOIN cov ON cov.doc_id = j.doc_id),
f AS (SELECT *, {all_chars} AS n_chars, {rest} AS rest, n_words < {bounds.min_words} OR 100 * n_repeat_words > {bounds.max_repeat_percent} * n_words AS base_failed FROM f0),
once AS (SELECT DISTINCT lang, h, {", ".join([*chars, *listed])}, n_words, rest FROM f
         WHERE lang IN ({", ".join(f"'{k}'" for k in COMMON_WORDS)}) AND n_words > 0 AND NOT base_failed),
ref AS (SELECT lang, {", ".join(f"sum({c}) / sum({all_chars}) AS {c}" for c in chars)}, {", ".join(f"sum({w}) / sum(n_words) AS {w}" for w in [*listed, "rest"])}
        FROM once GROUP BY lang),
d AS (SELECT f.*,
      CASE WHEN ref.lang IS NOT NULL AND n_chars >= {bounds.min_chars_judged} THEN {distance(p_chars, [f"ref.{c}" for c in chars])} END AS char_distance,
      CASE WHEN ref.lang IS NOT NULL AND n_words >= {bounds.min_words_judged} THEN {distance(p_words, [f"ref.{w}" for w in [*listed, "rest"]])} END AS word_distance
      FROM f LEFT JOIN ref ON ref.lang = f.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(char_distance > {bounds.max_char_distance}, FALSE) AND NOT coalesce(word_distance > {bounds.max_word_distance}, FALSE) AS kept,
       round(char_distance, 6) AS char_distance, round(word_distance, 6) AS word_distance FROM d
"""


OP7_SQL = _sql()
