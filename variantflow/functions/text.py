"""Prompt, payload, chat and path columns. All run inside the JVM."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from variantflow.schemas import NA_TOKENS

# --- fixed values -----------------------------------------------------------
PROMPT_HEAD = "Rewrite the following text to have a tone that is "
PROMPT_BREAK = ":\n\n"
PROMPT_TAIL = ". Be faithful to the original text. It must have the same amount of tokens."
REQUEST_SEED = 42
REQUEST_MODEL = "mistral"
ARTIFACT_PREFIX = "img_small_"
ARTIFACT_SUFFIX = ".jpg"
# --- end of fixed values ----------------------------------------------------


def prompt_template(text: Column, variant: Column) -> Column:
    """Rewrite instruction for one text. ``concat`` keeps any ``%`` in the text."""
    return F.concat(
        F.lit(PROMPT_HEAD), variant, F.lit(PROMPT_BREAK), text, F.lit(PROMPT_TAIL)
    )


def request_payload_json(
    prompt: Column, seed: int = REQUEST_SEED, model: str = REQUEST_MODEL
) -> Column:
    """JSON body of a text service request with one user message."""
    message = F.struct(F.lit("user").alias("role"), prompt.alias("content"))
    return F.to_json(
        F.struct(
            F.array(message).alias("messages"),
            F.lit(seed).alias("seed"),
            F.lit(model).alias("model"),
        )
    )


@dataclass(frozen=True)
class ChatDialect:
    """Role names and separators of a chat template."""

    user: str
    assistant: str
    role_sep: str = ": "
    open_turn: str = ":"
    turn_sep: str = "\n\n"


# --- fixed values -----------------------------------------------------------
PLAIN_DIALECT = ChatDialect("User", "Assistant")
TAGGED_DIALECT = ChatDialect("<|User|>", "<|Assistant|>")
# --- end of fixed values ----------------------------------------------------


def chat_messages(prompt: Column, dialect: ChatDialect = PLAIN_DIALECT) -> Column:
    """The user's turn followed by an assistant turn left open."""

    def turn(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(turn(dialect.user, prompt), turn(dialect.assistant, F.lit("")))


def chat_render(
    messages: Column, start_tag: str, dialect: ChatDialect = PLAIN_DIALECT
) -> Column:
    """Flatten messages to one prompt and append the tag that starts the output.

    A turn with content becomes role, separator, content, turn separator; a
    turn without content only opens the role.
    """
    parts = F.transform(
        messages,
        lambda m: F.when(
            m["content"] != "",
            F.concat(m["role"], F.lit(dialect.role_sep), m["content"], F.lit(dialect.turn_sep)),
        ).otherwise(F.concat(m["role"], F.lit(dialect.open_turn))),
    )
    return F.concat(F.array_join(parts, ""), F.lit(start_tag))


def chat_prompt(text: Column, start_tag: str, dialect: ChatDialect = PLAIN_DIALECT) -> Column:
    """:func:`chat_render` of :func:`chat_messages` as one concatenation.

    No arrays and no lambda, so it stays inside generated code.
    """
    asked = F.when(
        text != "", F.concat(F.lit(dialect.user + dialect.role_sep), text, F.lit(dialect.turn_sep))
    ).when(text == "", F.lit(dialect.user + dialect.open_turn))
    return F.concat(asked, F.lit(dialect.assistant + dialect.open_turn + start_tag))


def artifact_path(
    directory: str,
    slug: Column,
    row_idx: Column,
    prefix: str = ARTIFACT_PREFIX,
    suffix: str = ARTIFACT_SUFFIX,
) -> Column:
    """``<directory>/<slug>/<prefix><row><suffix>``."""
    return F.concat(
        F.lit(directory.rstrip("/") + "/"),
        slug,
        F.lit("/" + prefix),
        row_idx.cast("string"),
        F.lit(suffix),
    )


def normal_path(path: Column) -> Column:
    """Path without its ``file:`` scheme, so listings and tables agree."""
    return F.regexp_replace(path, r"^file:/+", "/")


def default_store(spark: SparkSession) -> str:
    """Where paths without a scheme are, as the session's file systems see it: ``file:`` or ``scheme://authority``."""
    name = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return "file:" if name.startswith("file:") else name.rstrip("/")


def qualified_path(path: Column, store: str) -> Column:
    """A path with its store, so that listings and tables agree whatever form either has.

    ``store`` is that of :func:`default_store`.  Hadoop's names of the object
    store connector are one; a relative path stays relative.
    """
    local = F.regexp_replace(path, r"^file:/+", "file:/")
    object_store = F.regexp_replace(local, r"^s3[an]://", "s3://")
    base = store.replace("s3a://", "s3://").replace("s3n://", "s3://")
    return F.when(F.startswith(object_store, F.lit("/")), F.concat(F.lit(base), object_store)).otherwise(object_store)


def null_if_na(value: Column, tokens: tuple[str, ...] = NA_TOKENS) -> Column:
    """NULL for every text that stands for a missing value."""
    return F.when(~value.isin(*tokens), value)


def key_uniform(*key: Column) -> Column:
    """Number in [0, 1) that depends only on the key, never on partitioning."""
    digest = F.md5(F.concat_ws(":", *[k.cast("string") for k in key]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
