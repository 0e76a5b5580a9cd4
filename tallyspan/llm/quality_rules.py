"""Operator 1, quality rules: thresholds learnt per language and source from mergeable sketches.

Every document is measured with built-in expressions.  The measures of all documents go
into log-linear histograms, one per (language, source) and measure: a quantile sketch whose
parts add up, so it combines before the shuffle and merges to coarser levels by adding
counts.  Quartiles read from a sketch give a fence for its own group: three times their distance
beyond them, and a slack of a few counts in a document of the group's lower quartile of size, which
is read from sketches of the sizes.  Fences of a group, its language and all documents are averaged,
a group weighing as much as it has documents against ``PRIOR``, so that small groups lean on
their language without a switch.  A join brings the fences back to the documents.

Defined results: NULL text counts as empty; NULL language or source is a group of its own;
a document without words fails the base rule; repeated rows are judged alike; columns beyond
those used pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import SPACE, kept, query, table, words_of
from tallyspan.operators.skew import join_small

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50
# As many documents as a language's fence counts beside a source's own, and that of all beside a language's.
PRIOR = 200
FENCE = 3
# Measures in integer units (see ``measured``), the size each is a share of, and how many counts in a
# document of the lower quartile of that size are added to its fence, so that a group whose documents
# are all alike does not reject the first that differs a little: symbols, repeated lines, words in
# repeated windows, words of twice the usual length.
SLACK = {"symbols_rate": ("n_words", 15), "dup_line_rate": ("n_lines", 2), "repeat_rate": ("n_words", 48), "word_length": ("n_words", 30)}
SIZES = ("n_words", "n_lines")
TWO_SIDED = ("word_length",)
LIMITS = [f"{m}_hi" for m in SLACK] + [f"{m}_lo" for m in TWO_SIDED]


def text_features(df: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines.

    Repeated three-word windows are found by sorting window hashes (64 bits) beside their
    places, inside the row; only documents that have any are sorted.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = df.withColumn("_words", words_of(text)).withColumn(
        "_lines", F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    )
    windows = split.select(
        *df.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("_words") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size("_words") - 3),
                lambda i: F.xxhash64(F.col("_words")[i], F.col("_words")[i + 1], F.col("_words")[i + 2]),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("_windows"),
    )
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = windows.withColumn(
        "_sorted",
        F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), placed).otherwise(
            F.array().cast("array<struct<h:bigint,i:int>>")
        ),
    )
    same = lambda x, i: x["h"].eqNullSafe(F.get("_sorted", i)["h"])
    twice = F.filter("_sorted", lambda x, i: same(x, i - 1) | same(x, i + 1))
    covered = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return ordered.select(
        *[c for c in windows.columns if c != "_windows"],
        F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def measured() -> dict[str, Column]:
    """Whole-number measures: symbols and repeated words per 1,000 words, repeated lines
    per 1,000 lines, mean word length in hundredths."""
    share = lambda a, b, unit: F.floor(F.col(a) * unit / F.greatest(F.col(b), F.lit(1)))
    return {
        "symbols_rate": share("n_symbols", "n_words", 1000),
        "dup_line_rate": share("n_dup_lines", "n_lines", 1000),
        "repeat_rate": share("n_repeat_words", "n_words", 1000),
        "word_length": share("word_chars", "n_words", 100),
    }


def bucket_of(value: Column) -> Column:
    """Log-linear bucket of a whole number >= 0: exact below 32, then 16 per doubling."""
    shift = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    return (shift * 16 + F.floor(value / F.pow(F.lit(2.0), shift))).cast("long")


def bucket_top(bucket: Column) -> Column:
    """Largest whole number of a bucket."""
    shift = F.greatest(F.floor(bucket / 16) - 1, F.lit(0))
    return ((bucket - shift * 16 + 1) * F.pow(F.lit(2.0), shift) - 1).cast("long")


def _levels(lang: Column, source: Column) -> Column:
    """A group's own sketch, its language's and that of all documents."""
    none = F.lit(None).cast("string")
    level = lambda n, l, s: F.struct(F.lit(n).alias("level"), l.alias("l"), s.alias("s"))
    return F.array(level(0, lang, source), level(1, lang, none), level(2, none, none))


def fences(features: DataFrame) -> DataFrame:
    """One row per (lang, source): ``{measure}_hi`` and, where two-sided, ``{measure}_lo``.

    Learnt from the documents that pass the base rule.  Histograms have at most about a
    thousand buckets, so the windows below see sketches, never documents.
    """
    long = features.where(~base_failed()).select(
        "lang", "source",
        F.inline(F.array(*[
            F.struct(F.lit(name).alias("measure"), bucket_of(value.cast("long")).alias("bucket"))
            for name, value in {**measured(), **{size: F.col(size) for size in SIZES}}.items()
        ])),
    )
    counts = long.groupBy("lang", "source", "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))
    levels = counts.select(
        F.inline(_levels(F.col("lang"), F.col("source"))), "measure", "bucket", "n"
    ).groupBy("level", "l", "s", "measure", "bucket").agg(F.sum("n").alias("n"))
    sketch = Window.partitionBy("level", "l", "s", "measure")
    running = levels.select(
        "*", F.sum("n").over(sketch.orderBy("bucket")).alias("upto"), F.sum("n").over(sketch).alias("total")
    )
    quartile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, bucket_top(F.col("bucket"))))
    quartiles = running.groupBy("level", "l", "s", "measure").agg(
        quartile(1).alias("q1"), quartile(3).alias("q3"), F.max("total").alias("total")
    )
    wide = quartiles.groupBy("level", "l", "s").agg(
        F.max("total").alias("total"),
        *[F.max(F.when(F.col("measure") == m, F.col(q))).alias(f"{m}_{q}") for m in (*SLACK, *SIZES) for q in ("q1", "q3")],
    )
    fence = {}
    for m, (size, counted) in SLACK.items():
        q1, q3 = F.col(f"{m}_q1"), F.col(f"{m}_q3")
        spread = (q3 - q1) * FENCE + F.floor(counted * (q3 if m == "word_length" else F.lit(1000)) / F.greatest(F.col(f"{size}_q1"), F.lit(1)))
        fence[f"{m}_hi"] = q3 + spread
        if m in TWO_SIDED:
            fence[f"{m}_lo"] = F.greatest(q1 - spread, F.lit(0))
    wide = wide.select("level", "l", "s", F.struct("total", *[fence[c].alias(c) for c in LIMITS]).alias("fence"))
    asked = counts.select(F.col("lang"), F.col("source")).distinct().select(
        "lang", "source", F.inline(_levels(F.col("lang"), F.col("source")))
    )
    same = [asked[c].eqNullSafe(wide[c]) for c in ("level", "l", "s")]
    found = asked.join(wide, same[0] & same[1] & same[2]).select("lang", "source", asked["level"], "fence")
    levels = found.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("level") == k, F.col("fence"))).alias(name) for k, name in enumerate(("own", "language", "every"))]
    )
    return levels.select("lang", "source", *[F.expr(_weighted("div", c)).alias(c) for c in LIMITS])


def _weighted(div: str, c: str) -> str:
    """SQL of a group's fence, from those of its own sketch, its language's and that of all."""
    language = f"((language.total * language.{c} + {PRIOR} * every.{c}) {div} (language.total + {PRIOR}))"
    return f"(own.total * own.{c} + {PRIOR} * {language}) {div} (own.total + {PRIOR})"


def judged(features: DataFrame) -> DataFrame:
    """Adds base_failed and kept to measured documents.  A group no document of which
    passes the base rule has no fence, and nothing of it is kept anyway."""
    limits = join_small(features, fences(features), ["lang", "source"], "left")
    outside = F.lit(False)
    for name, value in measured().items():
        outside = outside | (value > F.col(f"{name}_hi"))
        if name in TWO_SIDED:
            outside = outside | (value < F.col(f"{name}_lo"))
    return limits.select(
        *features.columns,
        base_failed().alias("base_failed"),
        (~base_failed() & ~F.coalesce(outside, F.lit(False))).alias("kept"),
    )


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    extra = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    names = {c: f"_in_{i}" for i, c in enumerate(docs.columns) if c not in ("text", "lang", "source")}
    marked = kept(text_features(docs.withColumnsRenamed(names)))
    passed = judged(marked).where("kept").drop(*extra, "base_failed", "kept")
    return passed.withColumnsRenamed({new: old for old, new in names.items()}).select(*docs.columns)


_RATE = """floor({a} * {unit} / greatest({b}, 1))"""
_SQL_MEASURES = {
    "symbols_rate": _RATE.format(a="n_symbols", b="n_words", unit=1000),
    "dup_line_rate": _RATE.format(a="n_dup_lines", b="n_lines", unit=1000),
    "repeat_rate": _RATE.format(a="n_repeat_words", b="n_words", unit=1000),
    "word_length": _RATE.format(a="word_chars", b="n_words", unit=100),
}
_SQL_SHIFT = "greatest(length(bin(v)) - 5, 0)"

SQL_FEATURES = r"""
d0 AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
d1 AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d0),
g AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d1)),
twice AS (SELECT doc_id, a, b, c FROM g GROUP BY ALL HAVING count(*) > 1),
cover AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM g SEMI JOIN twice USING (doc_id, a, b, c),
          (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
f AS (SELECT d1.doc_id, lang, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
        len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words
      FROM d1 LEFT JOIN cover USING (doc_id)),
fb AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)"""

SQL_KEPT = f"""WITH {SQL_FEATURES},
long AS ({" UNION ALL ".join(
    f"SELECT lang, source, '{m}' AS measure, CAST({v} AS BIGINT) AS v FROM fb WHERE NOT base_failed"
    for m, v in [*_SQL_MEASURES.items(), *zip(SIZES, SIZES)])}),
b AS (SELECT lang, source, measure, {_SQL_SHIFT} AS shift, {_SQL_SHIFT} * 16 + (v >> {_SQL_SHIFT}) AS bucket FROM long),
lv AS (SELECT 0 AS level, lang AS l, source AS s, measure, bucket, shift FROM b
       UNION ALL SELECT 1, lang, NULL, measure, bucket, shift FROM b
       UNION ALL SELECT 2, NULL, NULL, measure, bucket, shift FROM b),
h AS (SELECT level, l, s, measure, bucket, (bucket - shift * 16 + 1) * (1 << shift) - 1 AS top, count(*) AS n
      FROM lv GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY level, l, s, measure ORDER BY bucket) AS upto,
        sum(n) OVER (PARTITION BY level, l, s, measure) AS total FROM h),
q AS (SELECT level, l, s, measure, min(top) FILTER (upto * 4 >= total) AS q1,
        min(top) FILTER (upto * 4 >= total * 3) AS q3, max(total) AS total FROM r GROUP BY ALL),
w AS (SELECT level, l, s, max(total) AS total,
        {", ".join(f"max({q}) FILTER (measure = '{m}') AS {m}_{q}" for m in (*SLACK, *SIZES) for q in ("q1", "q3"))} FROM q GROUP BY ALL),
sp AS (SELECT *, {", ".join(f"({m}_q3 - {m}_q1) * {FENCE} + CAST(floor({n} * {f'{m}_q3' if m == 'word_length' else 1000} / greatest({size}_q1, 1)) AS BIGINT) AS {m}_spread"
                            for m, (size, n) in SLACK.items())} FROM w),
fe AS (SELECT level, l, s, CAST(total AS BIGINT) AS total, {", ".join(f"{m}_q3 + {m}_spread AS {m}_hi" for m in SLACK)},
         {", ".join(f"greatest({m}_q1 - {m}_spread, 0) AS {m}_lo" for m in TWO_SIDED)} FROM sp),
wide AS (SELECT own.l AS lang, own.s AS source, {", ".join(f"{_weighted('//', c)} AS {c}" for c in LIMITS)}
         FROM fe own JOIN fe language ON language.level = 1 AND language.l IS NOT DISTINCT FROM own.l
           JOIN fe every ON every.level = 2 WHERE own.level = 0)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce({" OR ".join(
      [f"{v} > {m}_hi" for m, v in _SQL_MEASURES.items()] + [f"{_SQL_MEASURES[m]} < {m}_lo" for m in TWO_SIDED])}, false) AS kept
FROM fb LEFT JOIN wide ON wide.lang IS NOT DISTINCT FROM fb.lang AND wide.source IS NOT DISTINCT FROM fb.source"""


@query("op1_quality_rules", SQL_KEPT)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    features = kept(text_features(docs).drop("text"))
    return judged(features).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
