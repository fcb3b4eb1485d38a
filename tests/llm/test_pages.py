import json
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from variantflow.llm import html_text as H
from variantflow.llm import warc as W

ARTICLE = (
    '<html><head><title>A  title</title><style>p{}</style><script>var t="</p>";</script></head><body>'
    '<nav><ul><li><a href="/x">Home</a></li></ul></nav><div class="ad">Buy this now please</div>'
    "<article><h1>A title</h1><p>One <b>bold</b>&amp; two.<br>Three<p>Four five.</p></article>"
    "<footer>&copy; us</footer></body></html>"
)
OTHER = (
    '<html><body><header><h1>Site</h1></header><div id="menu"><a href=/>Home</a></div><div class="cookie-notice"><p>We use '
    'cookies.</p></div><div class="content"><h1>Head</h1><p>First words here.<aside>beside</aside><form><p>Sign up</p></form>'
    "<ul><li>One</li><li>Two</li></ul><p>End &lt;here&gt;.</div><div class=comments><p>nice words of a reader</p></div></body></html>"
)


@pytest.fixture(scope="module")
def weights():
    return H.learn([ARTICLE] * 3)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=30))
def test_best_run_has_the_highest_sum(scores):
    start, end = H.best_run([float(s) for s in scores])
    best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=0)
    assert sum(scores[start:end]) == max(best, 0)


def test_main_text(weights):
    assert H.main_text(ARTICLE, weights) == "A title\n\nOne bold& two. Three\n\nFour five."
    assert H.main_text(OTHER, weights) == "Head\n\nFirst words here.\n\nOne\n\nTwo\n\nEnd <here>."


def marked(i: int) -> tuple[str, str]:
    """A page that marks its article, with names of elements that no list holds, and its text."""
    title, first, last = f"Title {i}", f"First words of page {i} and more.", f"Last words of {i}, the end."
    page = (
        f'<html><body><div class="zork"><ul><li><a href="/">Home {i}</a></li></ul></div><div class="blurb">Buy {i} now</div>'
        f'<article><h1>{title}</h1><p>{first}</p><p><b>{last}</b></p></article>'
        f'<div class="outro"><a href="/">Seen {i} times</a> by us all</div></body></html>'
    )
    return page, f"{title}\n\n{first}\n\n{last}"


def unmarked(page: str) -> str:
    return re.sub(r"(</?)article\b", r"\1div", page)


def test_learned_weights_find_the_text_of_pages_that_mark_nothing():
    """Half of the pages teach; the lists are emptied, and nothing but weights and run decides."""
    pages = [marked(i) for i in range(40)]
    learned = H.learn([page for page, _ in pages[::2]], prior={})
    for page, text in pages[1::2]:
        assert H.main_text(unmarked(page), learned) == text == H.main_text(page, learned)
        # neither the prior nor a scan without weights does it
        assert H.main_text(unmarked(page), H.Weights()) != text != H.main_text(unmarked(page), H.Weights({}))


def test_the_run_leaves_out_words_of_its_kind_far_from_it():
    learned = H.learn([marked(i)[0] for i in range(40)])
    page, text = marked(3)
    late = "<div class='outro'>" + "seen before " * 20 + "</div><p>Stray note.</p>"
    assert H.main_text(unmarked(page).replace("</body>", late + "</body>"), learned) == text
    inside = page.replace("<p><b>", "<div class='blurb'>Buy it</div><p>Kept.</p><p><b>")
    first, last = text.rsplit("\n\n", 1)
    assert H.main_text(unmarked(inside), learned) == f"{first}\n\nKept.\n\n{last}"


def test_prior_holds_where_pages_say_nothing_and_yields_where_they_do():
    many = H.learn([ARTICLE] * 500)
    comments = "<div class='comments'><p><b>Bold words of a reader</b></p><h1>Head</h1></div>"
    assert H.main_text(OTHER.replace("<p>End", comments + "<p>End"), many) == H.main_text(OTHER, many)
    listed = "<body><div class='junk'>No text</div><article class='widget'><p>All of it.</p></article></body>"
    assert H.main_text(listed, many) == "No text"
    # an article that is a widget by its class is text, once enough pages say so
    assert H.main_text(listed, H.learn([ARTICLE] * 250 + [listed] * 250)) == "All of it."


def test_fit_matches_plain_descent():
    words = {("a",): [5, 1], ("a", "b"): [0, 7], ("c",): [3, 3], (): [1, 2]}
    usual, found = H.fit(words, {"c": -2.0})

    def loss(w):
        total = (w[0] - H.USUAL) ** 2 / (2 * H.SPREAD**2) + (w[3] + 2) ** 2 / (2 * H.SELDOM_SPREAD**2)
        total += (w[1] ** 2 + w[2] ** 2) / (2 * H.SPREAD**2)
        for features, (other, content) in words.items():
            odds = w[0] + sum(w[1 + "abc".index(f)] for f in features)
            total += other * np.logaddexp(0, odds) + content * np.logaddexp(0, -odds)
        return total

    w = np.array([usual, found["a"], found["b"], found["c"]])
    for step in np.vstack([np.eye(4), -np.eye(4)]) * 1e-3:
        assert loss(w) < loss(w + step)


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!--", "</p></div>", "<script>", "<nav>only a menu</nav>", "\x00", "<p/>" * 50])
def test_broken_pages_have_no_text(weights, page):
    assert H.main_text(page, weights) in ("", "<", "<p", "\x00")


def test_extract_takes_awkward_tables(spark, weights):
    rows = [(1, "u", ARTICLE, "x"), (1, "u", ARTICLE, "x"), (None, None, None, None), (2, "v", "<p>" + "word " * 100_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extract(pages, H.learn_weights(pages), keep=["page_id", "url"]).collect()
    assert len(got) == 4 and all(r.n_chars == len(r.text) for r in got)
    assert sorted(len(r.text) for r in got)[0] == 0 and max(r.n_chars for r in got) == 499_999
    assert H.extract(pages.limit(0), weights, keep=["page_id"]).collect() == []


def pages_of(spark):
    rows = [(1, "http://a/b/", ARTICLE), (1, "http://a/b/", ARTICLE), (None, None, None), (2, "http://a/\r\nX: y", ""), (3, "http://[bad", OTHER)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("content", F.lit("clash"))


def test_records_are_linked(spark):
    responses = W.responses_of_pages(pages_of(spark))
    sources = {r.record_id: r for r in responses.collect()}
    assert len(sources) == 4  # a repeated row is the same capture
    made = W.derivatives(responses, "page_id").collect()
    assert len(made) == 10
    for r in made:
        source = sources[r.refers_to]
        fields = {h.name: h.value for h in r.headers}
        assert (r.page_id, r.target_uri, r.date) == (source.page_id, source.target_uri, source.date)
        assert fields["WARC-Refers-To"] == source.record_id and fields["WARC-Block-Digest"] == W.digest(r.content.encode())
        assert int(fields["Content-Length"]) == len(r.content.encode())
        if r.record_type == "metadata":
            told = json.loads(r.content)["Envelope"]
            assert told["WARC-Header-Metadata"] == {h.name: h.value for h in source.headers}
            http = told["Payload-Metadata"]["HTTP-Response-Metadata"]
            assert http["Entity-Digest"] == source.payload_digest == r.payload_digest
            assert http["Headers"] == {"Content-Type": "text/html; charset=utf-8"}
            if r.page_id == 1:
                assert http["HTML-Metadata"] == {"Head": {"Title": "A title"}, "Links": [{"path": "A@/href", "url": "http://a/x"}]}
        elif r.page_id == 1:
            assert r.content == "Home\nBuy this now please\nA title\nOne bold& two. Three\nFour five.\n© us"
    straight = W.derivatives_of_pages(pages_of(spark)).collect()
    assert sorted(map(str, straight)) == sorted(map(str, made))
    assert W.derivatives(W.responses_of_pages(pages_of(spark).limit(0))).collect() == []
    assert W.derivatives(W.derivatives(responses)).collect() == []  # only responses have derivatives


def archived(body: bytes, head: bytes = b"") -> bytes:
    block = b"HTTP/1.1 200 OK\r\n" + head + b"\r\n" + body
    fields = b"WARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Concurrent-To: a\r\nWARC-Concurrent-To: b\r\n"
    return b"WARC/1.1\r\n" + fields + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def test_repeated_headers_are_all_kept():
    head = b"Set-Cookie: a=1\r\nVia: x\r\nset-cookie: b=2\r\nSet-Cookie: a=1\r\n"
    (source,) = W.parse(archived(b"<p>hi", head))
    metadata, conversion = W.derive(dict(zip(W.NAMES, source)))
    told = json.loads(metadata[-1])["Envelope"]
    assert told["WARC-Header-Metadata"]["WARC-Concurrent-To"] == ["a", "b"]
    http = told["Payload-Metadata"]["HTTP-Response-Metadata"]["Headers"]
    assert http == {"Set-Cookie": ["a=1", "b=2", "a=1"], "Via": "x"}
    assert conversion[-1] == "hi" and conversion[2] == "<urn:uuid:1>"


@pytest.mark.parametrize(
    "head, body, text",
    [
        (b"", "caf\u00e9".encode(), "caf\u00e9"),
        (b"", b"caf\xe9", "caf\u00e9"),
        (b"Content-Type: text/html; charset=windows-1251\r\n", b"\xef\xf0\xe8", "\u043f\u0440\u0438"),
        (b"Content-Type: text/html; charset=nonsense\r\n", b"\xff", "\u00ff"),
        (b"", b"<p>" + b"w\xe9rd " * 300_000, ("w\u00e9rd " * 300_000).strip()),
    ],
)
def test_blocks_of_any_bytes_are_read(head, body, text):
    records = list(W.parse(archived(body, head) + archived(b"next")))
    assert [list(W.derive(dict(zip(W.NAMES, r))))[1][-1] for r in records] == [text, "next"]


def test_archives_round_trip(spark, tmp_path):
    responses = W.responses_of_pages(pages_of(spark)).drop("page_id")
    records = responses.unionByName(W.derivatives(responses)).repartition(3)
    told = W.write_archives(records, str(tmp_path / "out")).collect()
    assert sum(r.records for r in told) == 15
    back = W.read_archives(spark, str(tmp_path / "out"))
    assert sorted(map(str, back.collect())) == sorted(map(str, records.collect()))


def test_parse_refuses_what_is_no_record():
    with pytest.raises(ValueError):
        list(W.parse(b"nonsense\r\n\r\n"))
    assert re.match(r"<urn:uuid:[0-9a-f-]{36}>$", W.record_id("a", None))


def test_whole_pages_are_learned(spark):
    """The part that marks itself stands behind a very long head."""
    long = "<html><body><div class='junk'>" + "<i>x</i>" * 20_000 + "</div>" + ARTICLE + "</body></html>"
    weights = H.learn_weights(spark.createDataFrame([(i, long) for i in range(3)], "page_id long, html string"))
    assert weights == H.learn([long])
