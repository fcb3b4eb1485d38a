"""Derived web-archive records: metadata and plain-text conversion of responses.

Each response makes two records.  The conversion record holds the visible text of
the page, the metadata record a JSON document with the response's own headers and
digests, its title and its links.  Both refer to the response by its record id,
carry its target and date, and have digests of their own content; the source's
digests are kept as they are.

Records are rows (``RECORD``).  ``to_bytes`` and ``parse`` turn them into the
archive format and back, ``write_archives`` and ``read_archives`` do so for tables.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantflow.llm.batches import quoted
from variantflow.llm.hash_arrays import save_bytes
from variantflow.llm.html_text import INLINE, RAW, TOKEN

#: columns of a record; ``headers`` are all its named fields, in order
RECORD = (
    "record_id string, record_type string, refers_to string, target_uri string, date string, "
    "content_type string, block_digest string, payload_digest string, "
    "headers array<struct<name: string, value: string>>, content string"
)
HEADER = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
TYPES = [pa.string()] * 8 + [HEADER, pa.string()]
NAMES = [c.split()[0] for c in re.sub(r"array<.*?>>", "x", RECORD).split(", ")]
#: date of responses that have none
NO_DATE = "1970-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122


def digest(content: bytes) -> str:
    """A labelled digest as archives write it: SHA-1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(content).digest()).decode()


def record_id(*parts: str | None) -> str:
    """An id that depends on the parts alone, so a task that runs again gives the same."""
    named = "\x1f".join("\x00" if p is None else p for p in parts)
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, named)}>"


def _row(fields: list[tuple[str, str | None]], content: str) -> tuple:
    """A record from its named fields; fields without a value are left out."""
    fields = [(k, v) for k, v in fields if v is not None]
    fields.append(("Content-Length", str(len(content.encode()))))
    known = dict(fields)
    columns = ("WARC-Record-ID", "WARC-Type", "WARC-Refers-To", "WARC-Target-URI", "WARC-Date", "Content-Type",
               "WARC-Block-Digest", "WARC-Payload-Digest")
    return (*[known.get(c) for c in columns], [{"name": k, "value": v} for k, v in fields], content)


def response(page_id, url: str | None, page: str | None, date: str = NO_DATE) -> tuple:
    """The response record of a captured page; a NULL page is empty."""
    page = page or ""
    # a field is one line
    url = url if url is None else url.strip().replace("\r", "%0D").replace("\n", "%0A")
    content = HTTP + page
    payload = digest(page.encode())
    return _row(
        [
            ("WARC-Type", "response"),
            ("WARC-Record-ID", record_id("response", str(page_id), url, payload)),
            ("WARC-Target-URI", url),
            ("WARC-Date", date),
            ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", payload),
            ("WARC-Block-Digest", digest(content.encode())),
        ],
        content,
    )


def split_http(content: str) -> tuple[str, list[tuple[str, str]], str]:
    """Status line, headers and body of an HTTP message; content without a head is all body."""
    if not content.startswith("HTTP/"):
        return "", [], content
    head, _, body = content.partition("\r\n\r\n")
    status, *lines = head.split("\r\n")
    return status, [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines)], body


LINK = re.compile(r"(?:^|\s)(href|src)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def absolute(link: str, base: str | None) -> str:
    try:
        return urljoin(base or "", link)
    except ValueError:
        return link  # an address that can't be read is kept as it stands


def read_page(page: str, base: str | None) -> tuple[str | None, list[dict], str]:
    """Title, absolute links and visible text (a line for each block) of a page, in one scan."""
    title, links, blocks = None, [], [[]]
    at = 0
    while at < len(page):
        found = TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            blocks[-1].append(html.unescape(text) if "&" in text else text)
        if not found:
            break
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if name == "br":
            blocks[-1].append(" ")
        elif name not in INLINE and blocks[-1]:
            blocks.append([])
        if found[1]:
            continue
        if found[3]:
            for attribute, *values in LINK.findall(found[3]):
                links.append({"path": f"{name.upper()}@/{attribute.lower()}", "url": absolute("".join(values), base)})
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            if name == "title" and title is None:
                title = " ".join(page[at : close.start() if close else len(page)].split())
            at = close.end() if close else len(page)
    lines = (" ".join("".join(x).split()) for x in blocks)
    return title, links, "\n".join(x for x in lines if x)


def by_name(fields: list[tuple[str, str]]) -> dict[str, str | list[str]]:
    """Header values by name, in order; a name that is given more than once, in any case, has the list of its values."""
    spelled: dict[str, str] = {}
    values: dict[str, list[str]] = {}
    for name, value in fields:
        values.setdefault(spelled.setdefault(name.lower(), name), []).append(value)
    return {name: found[0] if len(found) == 1 else found for name, found in values.items()}


def derive(source: dict) -> Iterator[tuple]:
    """The metadata and the conversion record of a response record."""
    status, http, body = split_http(source["content"] or "")
    common = [
        ("WARC-Target-URI", source["target_uri"]),
        ("WARC-Date", source["date"]),
        ("WARC-Refers-To", source["record_id"]),
    ]
    title, links, text = read_page(body, source["target_uri"])
    envelope = {
        "Envelope": {
            "WARC-Header-Metadata": by_name([(h["name"], h["value"]) for h in source["headers"] or []]),
            "Payload-Metadata": {
                "HTTP-Response-Metadata": {
                    "Response-Message": status,
                    "Headers": by_name(http),
                    "Entity-Length": len(body.encode()),
                    "Entity-Digest": source["payload_digest"],
                    "HTML-Metadata": {"Head": {"Title": title}, "Links": links},
                }
            },
        }
    }
    for kind, mime, content in (
        ("metadata", "application/json", json.dumps(envelope, ensure_ascii=False)),
        ("conversion", "text/plain", text),
    ):
        yield _row(
            [
                ("WARC-Type", kind),
                ("WARC-Record-ID", record_id(kind, source["record_id"])),
                *common,
                ("Content-Type", mime),
                ("WARC-Payload-Digest", source["payload_digest"] if kind == "metadata" else None),
                ("WARC-Block-Digest", digest(content.encode())),
            ],
            content,
        )


def _batch(rows: list[tuple], extra: list[pa.Array] = (), names: list[str] = ()) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(TYPES)
    arrays = [pa.array(list(c), t) for c, t in zip(columns, TYPES)]
    return pa.RecordBatch.from_arrays([*extra, *arrays], names=[*names, *NAMES])


#: records that are sent on at once, by bytes of content
SENT = 4 << 20


def responses_of_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Response records of captured pages, with the key of each page.

    The id depends on key, address and content, so repeated rows are one capture
    and have one id.  A NULL address leaves the field out; a NULL page is empty.
    """

    def run(batches):
        for batch in batches:
            for part in _parts(batch, 2):
                rows = [response(*x) for x in zip(*(part.column(i).to_pylist() for i in range(3)))]
                yield _batch(rows, [part.column(0)], ["key"])

    narrow = pages.select(F.col(quoted(key)).alias("key"), F.col(quoted(url)).alias("url"), F.col(quoted(html)).alias("html"))
    kind = narrow.schema["key"].dataType.simpleString()
    return narrow.mapInArrow(run, f"key {kind}, {RECORD}").withColumnRenamed("key", key)


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch with about ``SENT`` bytes of one column."""
    start = held = 0
    for i, value in enumerate(batch.column(column)):
        held += len(value.as_py() or "")
        if held > SENT:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def derivatives(responses: DataFrame, key: str | None = None) -> DataFrame:
    """Two records for each response record, with the response's key if there is one.

    Responses without content give an empty text; other record types give nothing.
    """
    keep = [F.col(quoted(key)).alias("key")] if key else [F.lit(None).cast("long").alias("key")]
    narrow = responses.where("record_type = 'response'").select(*keep, *NAMES)

    def run(batches):
        for batch in batches:
            for part in _parts(batch, len(NAMES)):
                keys, rows = [], []
                for source in part.to_pylist():
                    for row in derive(source):
                        keys.append(source["key"])
                        rows.append(row)
                yield _batch(rows, [pa.array(keys, part.column(0).type)], ["key"])

    kind = narrow.schema["key"].dataType.simpleString()
    made = narrow.mapInArrow(run, f"key {kind}, {RECORD}")
    return made.withColumnRenamed("key", key) if key else made.drop("key")


def derivatives_of_pages(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """:func:`derivatives` of :func:`responses_of_pages` in one pass, without the responses in between."""

    def run(batches):
        for batch in batches:
            for part in _parts(batch, 2):
                keys, rows = [], []
                for x in zip(*(part.column(i).to_pylist() for i in range(3))):
                    for row in derive(dict(zip(NAMES, response(*x)))):
                        keys.append(x[0])
                        rows.append(row)
                yield _batch(rows, [pa.array(keys, part.column(0).type)], ["key"])

    narrow = pages.select(F.col(quoted(key)).alias("key"), F.col(quoted(url)).alias("url"), F.col(quoted(page)).alias("page"))
    kind = narrow.schema["key"].dataType.simpleString()
    return narrow.mapInArrow(run, f"key {kind}, {RECORD}").withColumnRenamed("key", key)


# --- files ------------------------------------------------------------------
def to_bytes(headers: list[dict], content: str) -> bytes:
    """A record in the archive format."""
    head = "".join(f"{h['name']}: {h['value']}\r\n" for h in headers)
    return f"WARC/1.1\r\n{head}\r\n".encode() + content.encode() + b"\r\n\r\n"


CHARSET = re.compile(rb"charset\s*=\s*[\"']?([\w.:-]+)", re.I)


def decoded(block: bytes) -> str:
    """A block as text: UTF-8, or else the character set that it names, or else latin1, which any byte is."""
    named = CHARSET.search(block[:4096])
    for charset in ("utf-8", *([named[1].decode("ascii", "replace")] if named else [])):
        try:
            return block.decode(charset)
        except (UnicodeError, LookupError):
            continue
    return block.decode("latin1")


def parse(data: bytes) -> Iterator[tuple]:
    """Records of an archive (not compressed), whatever their type.

    Blocks and headers that are no UTF-8 are decoded as :func:`decoded` says.  Ids and
    digests stay those of the source; the length is that of the content as UTF-8.
    """
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = decoded(data[at:end]).split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = [(k, v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])]
        size = int(next(v for k, v in fields if k.lower() == "content-length"))
        content = decoded(data[end + 4 : end + 4 + size])
        yield _row([(k, v) for k, v in fields if k.lower() != "content-length"], content)
        at = end + 4 + size + 4


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write one compressed archive for each partition, each record a member of its own; (file, records).

    A task that runs again writes the same file anew.
    """

    def run(batches):
        part = TaskContext.get().partitionId()
        members, n = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                members.append(gzip.compress(to_bytes(row["headers"], row["content"] or ""), mtime=0))
                n += 1
        if n:
            name = f"{folder}/part-{part:05d}.warc.gz"
            save_bytes(name, b"".join(members))
            yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([n], pa.int64())})

    return records.select("headers", "content").mapInArrow(run, "file string, records long")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all ``.warc.gz`` files of a folder; a task reads a file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                yield _batch(list(parse(gzip.decompress(data.as_py()))))

    return files.select("content").mapInArrow(run, RECORD)
