"""One query per operator over its whole table, and the SQL twins that SQL can state."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from skylattice.llm import (
    decontaminate,
    filter_audit,
    html_extract,
    jaccard_join,
    language_id,
    line_dedup,
    packing,
    quality_rules,
    rule_classifier,
    simhash,
    substring_dedup,
    suffix_dedup,
    whitening,
)
from skylattice.queries.registry import Query
from skylattice.sources.readers import read_parquet

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query of this subpackage."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


@query("op1_suffix_array_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without 50-byte strings that also start in an earlier one."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), size=50, with_bytes=False)


@query(
    "op2_substring_dedup",
    r"""
    WITH d AS (
      SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
      FROM documents
    ),
    wins AS (
      SELECT doc_id, i, md5(array_to_string(ws[i : i + 34], ' ')) AS h
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d)
    ),
    twice AS (SELECT h FROM wins GROUP BY h HAVING count(*) > 1),
    gone AS (
      SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS place FROM wins JOIN twice USING (h)
    ),
    left_over AS (
      SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.place) AS kept, count(*) AS n_kept
      FROM (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM d) w
      ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.place = g.place
      GROUP BY w.doc_id
    )
    SELECT d.doc_id, len(ws) AS n_words, len(ws) - coalesce(n_kept, 0) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN left_over l ON d.doc_id = l.doc_id
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without 35-word windows that occur twice."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), size=35, with_text=False)


@query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from four of five folds of ``labels``."""
    return rule_classifier.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=5, held_out=0, threshold=0.3
    )


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 3-word shingles and their groups at 3 bits."""
    return simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, distance=3)


@query("op5_html_extraction")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query(
    "op6_line_dedup",
    r"""
    WITH lines AS (
      SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
    ),
    three AS (
      SELECT doc_id, pos, line,
             lead(line, 1) OVER w AS line2, lead(line, 2) OVER w AS line3,
             lead(pos, 2) OVER w AS last
      FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
    ),
    ranked AS (
      SELECT doc_id, pos,
             row_number() OVER (PARTITION BY line, line2, line3 ORDER BY doc_id, pos) AS nth
      FROM three
      WHERE last IS NOT NULL AND regexp_matches(line || line2 || line3, '[^\x20\x09-\x0D]')
    ),
    gone AS (
      SELECT DISTINCT doc_id, pos + step AS pos
      FROM ranked, (VALUES (0), (1), (2)) s(step) WHERE nth > 1
    )
    SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
           sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '')) AS kept_sha256
    FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
    GROUP BY l.doc_id
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left after removing later copies of three-line windows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, size=3).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and compression verdict of every document."""
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


@query(
    "op8_benchmark_decontamination",
    r"""
    WITH d AS (
      SELECT doc_id, list_filter(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents
    ),
    b AS (
      SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark
    ),
    needles AS (
      SELECT DISTINCT item, least(10, len(ws)) AS n, array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') AS phrase
      FROM (SELECT item, ws, unnest(range(1, greatest(2, len(ws) - 8))) AS i FROM b WHERE len(ws) > 0)
    ),
    hay AS (
      SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS phrase
      FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
            FROM d, (SELECT DISTINCT n FROM needles))
    ),
    found AS (SELECT doc_id, i, hay.n, item FROM hay JOIN needles USING (phrase) WHERE hay.n = needles.n),
    hits AS (
      SELECT doc_id, count(DISTINCT place) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id
    ),
    items AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
      FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside ten-word windows of the benchmark."""
    return decontaminate.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10
    ).drop("items")


@query("op8_benchmark_proximity")
def op8_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the items whose windows' words stand near each other, in any order."""
    return decontaminate.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10, slop=5
    ).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        "items_sha256",
        "contaminated",
        F.size("near_items").cast("long").alias("n_near_items"),
        F.sha2(F.array_join("near_items", ","), 256).alias("near_items_sha256"),
        (F.size("near_items") > 0).alias("near"),
    )


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three of four folds."""
    return language_id.identify(table(spark, sf_dir, "documents"), folds=4, held_out=2)


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    return packing.pack(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        capacity=1024,
        end_id=0,
    )


@query("op11_ngram_jaccard_join")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of 5-word shingles overlap by 80 %."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), shingle=5, percent=80)


@query(
    "op12_filter_interaction_audit",
    r"""
    WITH d AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
             list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
      FROM documents
    ),
    firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
    failing AS (
      SELECT d.doc_id, part,
             CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END
             || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(d.t, '[^A-Z]+', '', 'g')) > 10 * length(d.t) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 'D' ELSE '' END
             || CASE WHEN first_id < d.doc_id THEN 'E' ELSE '' END AS mask
      FROM d JOIN firsts ON d.t = firsts.t
    ),
    marks AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
    counted AS (
      SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
      FROM failing LEFT JOIN marks USING (doc_id) GROUP BY part, mask
    ),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
    orders AS (
      SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
      FROM letters a, letters b, letters c, letters d, letters e
      WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
    ),
    steps AS (
      SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
      FROM orders, (SELECT unnest(range(1, 6)) AS step)
    ),
    judged AS (
      SELECT part, filter_order, CAST(step AS INTEGER) AS step, f, n, good, toxic, mask,
             contains(mask, f) AS fails,
             regexp_matches(mask, '[ ' || before || ']') AS gone
      FROM counted, steps
    ),
    summed AS (
      SELECT part, filter_order, step, f,
             coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0) AS kept,
             coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0) AS removed,
             coalesce(sum(n) FILTER (WHERE gone AND fails), 0) AS redundant,
             coalesce(sum(n) FILTER (WHERE mask = f), 0) AS unique_fails,
             coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0) AS good_lost,
             coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails), 0) AS toxic_lost
      FROM judged GROUP BY ALL
    )
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
           CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
    FROM summed
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all their orders, by language."""
    counts = filter_audit.counted_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit(counts, "ABCDE", "part", ["rows", "good", "toxic"]).withColumnsRenamed(
        {"lost_good": "good_lost", "lost_toxic": "toxic_lost"}
    )


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as scaled integers, whitened along their first eight components."""
    fine = whitening.same_length(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    vectors = fine.select("vec_id", whitening.scaled_integers(F.col("embedding")).alias("x"))
    vectors = vectors.where(whitening.usable(F.col("x")))
    model = whitening.fit(vectors, "x")
    error = model.identity_error(vectors, "x", 8)
    explained = F.array(*[F.lit(e) for e in model.explained(8)] or [F.lit(0.0)])
    return (
        model.transform(
            vectors.withColumn("deviation", whitening.squared_deviation(F.col("x"), model.sums, model.n)), "x", 8
        )
        .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            "vec_id",
            (F.col("at") + 1).alias("component"),
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(explained, F.col("at")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
