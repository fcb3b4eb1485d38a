"""The operators of this subpackage as named queries on the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantflow.llm.batches import fold
from variantflow.llm.conversation_trie import prefix_trie, turn_sequences
from variantflow.llm.decontamination import contaminated, n_hit, scan_benchmark
from variantflow.llm.html_text import extract, learn_weights
from variantflow.llm.jaccard_join import jaccard_classes
from variantflow.llm.language import fit_languages, identify
from variantflow.llm.language_model import fit_language_model, score_texts
from variantflow.llm.licenses import fit_licenses, scan_licenses
from variantflow.llm.minhash_forest import near_duplicates
from variantflow.llm.packing import pack
from variantflow.llm.periodic_runs import periodic_runs
from variantflow.llm.quality import judge
from variantflow.llm.toxicity import THRESHOLD, fit_toxicity, score_toxicity
from variantflow.llm.warc import derivatives_of_pages

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows where SQL can express it."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_sql(text: str) -> str:
    """DuckDB expression: unsigned crc32 of an ASCII text."""
    step = "list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: if(x % 2 = 1, xor(x >> 1, 3988292384), x >> 1))"
    codes = f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda a, b: {step}), 4294967295)"


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _components_sql(size: int, percent: int) -> str:
    """Components of documents that share ``percent`` of their shingles."""
    return f"""WITH RECURSIVE
        d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + {size - 1}) AS g
              FROM d, unnest(range(1, greatest(len(w) - {size - 1}, 1) + 1)) AS t(i) WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
                   FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY x, y),
        links AS (SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
                  WHERE 100 * c >= {percent} * (nx.n + ny.n - c)),
        reach AS (SELECT doc_id, doc_id AS other FROM d
                  UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
        SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
        FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id"""


@query("op3_jaccard_join", _components_sql(3, 90))
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"), size=3, threshold="9/10")


_ITEM_WORDS = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    "op7_benchmark_decontamination",
    f"""WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
        windows AS (SELECT item_id, list_slice(w, i, i + 12) AS g
                    FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
        lengths AS (SELECT DISTINCT len(g) AS n FROM windows),
        runs AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS g
                 FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS t(i)),
        hits AS (SELECT doc_id, i, n, item_id FROM runs JOIN windows USING (g)),
        marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
        named AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ks
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM hits) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ks, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)""",
)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = scan_benchmark(docs, items, keep=["doc_id"], name="found")
    n_words, items = F.col("found.n_words"), F.col("found.items")
    return found.select(
        "doc_id",
        n_words.alias("n_words"),
        n_hit("found").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(n_hit("found"), n_words).alias("contaminated"),
    )


@query("op9_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


LANGUAGE_FOLD = (4, 2)


@query("op2_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", *LANGUAGE_FOLD)
    model = fit_languages(docs.where(~held_out))
    found = identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


TOXICITY_FOLD = (3, 1)


@query("op4_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", *TOXICITY_FOLD)
    model = fit_toxicity(docs, labels.where(~held_out))
    found = score_toxicity(docs, model, keep=["doc_id"])
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return found.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


MODEL_FOLD = (7, 2)
#: words of the longest sequences of the language model
MODEL_ORDER = 3


@query("op6_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", *MODEL_FOLD)
    model = fit_language_model(docs.where(~held_out), order=MODEL_ORDER)
    found = score_texts(docs, model, keep=["doc_id"])
    return found.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query("op5_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


@query("op8_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, learn_weights(pages), keep=["page_id", "url"])


@query("op1_license_scans")
def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan_licenses(docs, fit_licenses(docs), keep=["doc_id"])


@query("op10_warc_derivatives")
def warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives_of_pages(table(spark, sf_dir, "pages")).withColumn("headers", F.to_json("headers"))


def tail_repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which the end of some texts, told by the crc32 of their doc_id, is written periodically."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    drawn = F.floor(h / 10)
    words = docs.select(
        "doc_id",
        "text",
        F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))).alias("w"),
        drawn.alias("g"),
    ).withColumn("n", F.size("w").cast("long"))
    start = F.col("g") % F.col("n")
    words = words.withColumn("a", F.when(F.col("n") > 0, start))
    words = words.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    moved = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("w", place(i).cast("int"))
    )
    text = F.when(F.col("n") > 0, F.array_join(moved, " ")).otherwise(F.col("text"))
    return words.select("doc_id", text.alias("text"))


@query("op12_periodic_runs")
def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tail_repeated(table(spark, sf_dir, "documents"))
    found = periodic_runs(docs, keep=["doc_id"])
    # the longest run, then the first, then that of the smallest period
    order = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    longest = F.array_max(order)
    start, length, period = -longest["col2"], longest["length"], -longest["col3"]
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the first turns of the first conversation of five, then the conversation's own."""
    own = turn_sequences(turns)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    # at most eight turns of every fifth conversation are shared
    first = own.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("shared"))
    joined = own.withColumn("base", F.expr("conv_id - conv_id % 5")).withColumn("h", h).join(first, "base", "left")
    shared = F.coalesce(F.slice("shared", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(shared, rest).alias("turns"))


@query(
    "op13_conversation_trie",
    f"""WITH own AS (SELECT conv_id AS c, list((coalesce(role, ''), coalesce(text, '')) ORDER BY turn NULLS FIRST) AS ts
                 FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        hashed AS (SELECT c, ts, {crc32_sql("c::VARCHAR")} % 9 AS h FROM own),
        built AS (SELECT x.c, list_concat(coalesce(b.ts[1:x.h], []), x.ts[x.h + 1:]) AS ts
                  FROM hashed x LEFT JOIN own b ON b.c = x.c - x.c % 5),
        members AS (SELECT c, d, ts[1:d] AS p, len(ts) AS n FROM built, unnest(range(0, len(ts) + 1)) AS t(d)),
        nodes AS (SELECT d, p, min(c) AS conv_id, count(*) AS n_convs,
                         string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d) AS ends
                  FROM members GROUP BY d, p),
        children AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
        full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
                              CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(p[-1][2]) END AS saved
                       FROM nodes n LEFT JOIN children USING (d, p)),
        subtree AS (SELECT k AS d, p[1:k] AS p, count_if(n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
                    FROM full_nodes, unnest(range(0, d + 1)) AS t(k) GROUP BY ALL)
        SELECT x.conv_id, x.d AS depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves::BIGINT AS n_leaves,
               saved_tokens, sha256(coalesce(x.ends, '')) AS ends_sha256
        FROM full_nodes x JOIN subtree USING (d, p)
        LEFT JOIN nodes y ON y.d = x.d - 1 AND y.p = x.p[1:x.d - 1]""",
)
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))


@query("op11_minhash_forest", f"SELECT *, doc_id = component_id AS kept FROM ({_components_sql(4, 80)})")
def minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, threshold="8/10")
