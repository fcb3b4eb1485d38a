"""Sources and sinks.  Files are first written from the tables by Spark."""

from __future__ import annotations

from pyspark.sql import functions as F

from variantflow.catalog.base import SQL_FEATURES, SQL_VARIANTS, descriptions, parallelism, query, table
from variantflow.catalog.png import png_column
from variantflow.catalog.vectors import vectors
from variantflow.functions.arrays import dequantize
from variantflow.operators.manifest import manifest_join
from variantflow.operators.variants import fan_out
from variantflow.schemas import NA_TOKENS, SLUGS, VARIANTS, slug_of
from variantflow.sources.artifacts import (
    artifact_manifest,
    image_scan,
    probe_artifacts,
    write_artifacts,
)
from variantflow.sources.csv import csv_export, csv_scan, encoding_fallback_scan
from variantflow.sources.scratch import new_folder
from variantflow.sources.state import load_or_init, read_routed, save_variant_tables, write_routed

_NA_SQL = "(" + ", ".join(f"'{t}'" for t in NA_TOKENS) + ")"
_DOCS_SQL = f"""SELECT doc_id,
       CASE WHEN text NOT IN {_NA_SQL} THEN text END AS text,
       CASE WHEN lang NOT IN {_NA_SQL} THEN lang END AS lang,
       CASE WHEN source NOT IN {_NA_SQL} THEN source END AS source,
       n_chars FROM documents"""


@query("csv_scan", _DOCS_SQL)
def scanned(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "csv-scan")
    csv_export(docs, folder)
    return csv_scan(spark, folder, docs.schema)


@query("csv_export", "SELECT page_id, url, html FROM pages")
def exported(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    folder = new_folder(spark, "csv-export")
    csv_export(pages, folder)
    return csv_scan(spark, folder, pages.schema, na_tokens=False)


@query("encoding_fallback_scan", _DOCS_SQL)
def two_encodings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "csv-encodings")
    # French texts that latin1 can hold go to latin1 files, all others to UTF-8
    latin = (F.col("lang") == "fr") & F.col("text").rlike(r"^[\x00-\xff]*$")
    csv_export(docs.filter(latin), f"{folder}/a", encoding="ISO-8859-1")
    csv_export(docs.filter(~latin), f"{folder}/b")
    return encoding_fallback_scan(spark, [f"{folder}/a", f"{folder}/b"], docs.schema)


@query(
    "load_or_init",
    f"""WITH {SQL_VARIANTS} SELECT variant, text AS description_original,
              '[' || variant || '] ' || text AS reply
        FROM documents CROSS JOIN variants""",
)
def loaded(spark, sf_dir):
    told = F.concat(F.lit("["), F.col("variant"), F.lit("] "), F.col("text"))
    state = fan_out(descriptions(spark, sf_dir)).select(
        "variant", F.col("text").alias("original_text"), told.alias("reply")
    )
    root = new_folder(spark, "state")
    save_variant_tables(state, root)
    tables = load_or_init(spark, root)
    parts = [
        tables[v].select(
            F.lit(v).alias("variant"),
            "description_original",
            F.col(f"description_{slug_of(v)}").alias("reply"),
        )
        for v in VARIANTS
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


@query(
    "variant_routed_sink",
    f"""WITH {SQL_VARIANTS} SELECT doc_id AS row_idx, text, variant, slug
        FROM documents CROSS JOIN variants""",
)
def routed(spark, sf_dir):
    rows = fan_out(descriptions(spark, sf_dir))
    folder = new_folder(spark, "routed")
    write_routed(rows, folder)
    back = read_routed(spark, folder, rows.schema)
    return back.filter(F.col("slug").isin(*SLUGS)).select("row_idx", "text", "variant", "slug")


def images_of(spark, sf_dir, folder, **shapes):
    """Write every vector as a small image of each shape below ``folder``."""
    rows = vectors(spark, sf_dir).repartition(parallelism(spark))
    levels = rows.select("vec_id", dequantize(F.col("features")).alias("levels"))

    def file(kind, width, height, channels):
        name = F.concat(
            F.lit(f"{folder}/{kind}/img_small_"), F.col("vec_id").cast("string"), F.lit(".png")
        )
        content = png_column(F.col("levels"), width, height, channels)
        return F.struct(name.alias("path"), content.alias("content"))

    files = levels.select(F.inline(F.array(*[file(k, *shape) for k, shape in shapes.items()])))
    write_artifacts(files, "path", "content").write.format("noop").mode("overwrite").save()


@query(
    "artifact_manifest",
    """SELECT vec_id, kind, kind = 'png' AS listed, kind = 'png' AS probed
       FROM embeddings CROSS JOIN (VALUES ('png'), ('jpg')) AS k(kind)""",
)
def listed(spark, sf_dir):
    folder = new_folder(spark, "artifacts")
    images_of(spark, sf_dir, folder, grey=(8, 8, 1))
    kinds = F.explode(F.array(F.lit("png"), F.lit("jpg"))).alias("kind")
    rows = vectors(spark, sf_dir).select("vec_id", kinds)
    path = F.concat(
        F.lit(f"{folder}/grey/img_small_"), F.col("vec_id").cast("string"), F.lit("."), F.col("kind")
    )
    rows = rows.withColumn("generated_filename", path)
    probed = probe_artifacts(rows, name="probed")
    found = manifest_join(probed, artifact_manifest(spark, folder), salt=["vec_id"])
    return found.select("vec_id", "kind", F.col("present").alias("listed"), "probed")


@query(
    "image_scan",
    f"""WITH {SQL_FEATURES},
        l AS (SELECT vec_id, list_transform(f, lambda x:
                printf('%02X', floor(least(greatest((x + 1) / 2 * 255, 0), 255))::INTEGER)) AS l
              FROM features)
        SELECT vec_id, 'grey' AS kind, 8 AS height, 8 AS width, 1 AS channels,
               array_to_string(list_transform(l, lambda x: x || x || x), '') AS rgb FROM l
        UNION ALL
        SELECT vec_id, 'rgba', 4, 4, 4,
               array_to_string(list_transform(range(16),
                 lambda i: l[i * 4 + 1] || l[i * 4 + 2] || l[i * 4 + 3]), '') FROM l""",
)
def images(spark, sf_dir):
    folder = new_folder(spark, "images")
    images_of(spark, sf_dir, folder, grey=(8, 8, 1), rgba=(4, 4, 4))
    name = F.regexp_extract("path", r"/([a-z]+)/img_small_(\d+)\.png$", 1)
    number = F.regexp_extract("path", r"/([a-z]+)/img_small_(\d+)\.png$", 2)
    return image_scan(spark, folder).select(
        number.cast("long").alias("vec_id"),
        name.alias("kind"),
        "height",
        "width",
        "channels",
        F.hex("rgb").alias("rgb"),
    )
