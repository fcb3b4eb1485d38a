"""Tables of awkward rows that every operator must take, and plain versions of the rules."""

import re
import zlib

from pyspark.sql import types as T

BLANK_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})

ENGLISH = "the cat of the house is on that old chair and it was there for all the days of this long year"
GERMAN = "der hund und die katze sind nicht mit dem alten mann auf der langen straße über den schönen berg gegangen"
FRENCH = "le chat de la maison est sur une vieille chaise et les enfants ont été dans le jardin avec leur mère"
SPANISH = "el gato de la casa está en una silla vieja y los niños han estado en el jardín con su madre señora"

#: columns with the names that operators use themselves
CLASH = ["score", "n_words", "sid", "text_1", "f0", "k0", "lang_pred", "stays", "held_out", "ids", "signatures", "contamination"]


def docs_schema():
    base = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
            ("n_chars", T.LongType())]
    return T.StructType([T.StructField(n, t) for n, t in base] + [T.StructField(c, T.StringType()) for c in CLASH])


def docs(spark, rows):
    """(doc_id, text, lang, source) rows as documents with clashing columns."""
    full = [(*r, None if r[1] is None else len(r[1]), *[f"{c} of {r[0]}" for c in CLASH]) for r in rows]
    return spark.createDataFrame(full, docs_schema())


def awkward(spark):
    long = " ".join(f"{ENGLISH} {i}" for i in range(3000))
    rows = [
        (1, ENGLISH, "en", "a"), (1, ENGLISH, "en", "a"),  # a repeated row
        (2, None, "en", "a"), (3, "", None, None), (4, " \n\t ", "de", "a"), (5, "!!! 123 ...", "en", "b"),
        (6, long, "en", "a"), (7, long + " more", "en", "a"), (None, GERMAN, "de", "a"), (None, None, None, None),
        (8, GERMAN, "de", None), (9, FRENCH, None, "b"), (10, SPANISH, "es", "b"), (11, "a", "en", "a"),
        (12, "x" * 300_000, "en", "a"), (13, ENGLISH.upper(), "en", "a"), (14, "é  ñ　 ü", "es", "c"),
    ]
    return docs(spark, rows)


def empty(spark):
    return docs(spark, [])


def words(text):
    return BLANK_WORDS.findall((text or "").translate(LOWER))


def crc(key):
    return zlib.crc32(str(key).encode())
