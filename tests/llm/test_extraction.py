"""HTML text, personal data, contamination, WARC archives and packing against brute force."""

from __future__ import annotations

import hashlib
import io
import random
import re
import zlib
from html import unescape

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from ordertally.llm import decontaminate, html_text, packing, pii, warc_archive
from ordertally.llm.common import words_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, **extra):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).withColumns({k: F.lit(v) for k, v in extra.items()})


# --- HTML -----------------------------------------------------------------


@pytest.fixture(scope="module")
def tree():
    return html_text.train_tree(html_text._BLOCK_TABLE)


def test_given_pages_give_their_article_text(spark, sf_small, tree):
    for r in spark.read.parquet(f"{sf_small}/pages.parquet").select("html").collect():
        article = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert html_text.main_text(r.html, tree) == "\n\n".join(b for b in blocks if b)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<div><div>", ""),
        ("<article><p>a &lt; b &amp; c&nbsp;d<br>e</p></article>", "a < b & c d e"),
        ("<article><p>5 < 6 <b>bo</b>ld</article>", "5 < 6 bold"),
        ("<article><p>one<p>two<ul><li>three<li>four</ul></article>", "one\n\ntwo\n\nthree\n\nfour"),
        ("<article><h1>T</h1><form>name <input></form><aside>see</aside><p>x</p></article>", "T\n\nx"),
        ("<article><p>x</p><section class='comments'><article><p>nice one</p></article></section></article>", "x"),
        ("<header><h1>Site</h1></header><main><header><h1>T</h1></header><p>x</p></main><footer>f</footer>", "T\n\nx"),
        ("<article>a<script>if (a<b) {'</p>'}</script><style>p{}</style><!-- <p>no</p> -->b</article>", "ab"),
        ("<div class='page has-sidebar'><article class='post with-ads'><div class='article-header'><h1>T</h1></div><p>x</article>", "T\n\nx"),
        ("<div class='header'>Site name</div><div id='content'><p>Some text of the page.</p></div>", "Some text of the page."),
        ("<main><p>x</p><div class='related'><article><p>Other story</p></article></div></main>", "x"),
        ("<article><div class='cookie-notice'>We use cookies</div><p>x<!-- cut", "x"),
    ],
)
def test_page_cases(tree, page, text):
    assert html_text.main_text(page, tree) == text


def test_extract_text_table(spark):
    rows = [(1, "u", "<article><p>é x</p></article>", 7), (1, "u", "<article><p>é x</p></article>", 7), (None, None, None, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, Text int")
    got = sorted(html_text.op1(pages).collect(), key=str)
    assert [tuple(r) for r in got] == [(1, "u", "é x", 3), (1, "u", "é x", 3), (None, None, "", 0)]
    assert html_text.extract_text(pages).columns == ["page_id", "url", "html", "text", "n_chars"]
    assert html_text.op1(pages.limit(0)).collect() == []


def test_a_very_long_page(tree):
    body = "<p>word here</p>" * 50_000
    assert html_text.main_text(f"<article>{body}</article>", tree).count("\n\n") == 49_999
    assert html_text.main_text("<" * 100_000, tree) in ("", "<" * 100_000)


# --- personal data ----------------------------------------------------------


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        t += v // 10 + v % 10
    return t % 10 == 0


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@pytest.mark.parametrize("alphabet", ["aA1234567890@@..+- ()%é\n", ["0", "1", "9", "4", "25", "255", ".", ".", " ", "-", "+"]])
def test_base_spans_equal_the_patterns(alphabet):
    rng = random.Random(3)
    for _ in range(20_000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert [x for x in pii.find_spans(t) if x[1] < 4] == base_spans(t), t


def test_base_spans_of_the_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = {r.doc_id: r for r in pii.op5(docs).collect()}
    for r in docs.collect():
        base = base_spans(r.text or "")
        said = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        x = got[r.doc_id]
        assert x.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (x.n_email, x.n_ip, x.n_card, x.n_phone) == tuple(sum(b[1] == k for b in base) for k in range(4))
        assert set(said.split(",")) - {""} <= set(x.spans.split(","))


def test_added_kinds_and_redaction(spark):
    text = "IBAN DE89 3704 0044 0532 0130 00, a.b@c.de, http://x.org/?q=a@b.com."
    assert pii.redacted(text) == "IBAN [ACCOUNT], [EMAIL], [ADDRESS]."
    assert pii.find_spans("iban DE89 3704 0044 0532 0130 01") == []
    docs = documents(spark, [text, None, "", "clean"], spans="mine", Base_SHA256=1)
    out = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert pii.redact(docs).columns == docs.columns
    assert out[0].text == pii.redacted(text) and out[0].n_chars == len(out[0].text) and out[0].spans == "mine"
    assert [out[i].text for i in (1, 2, 3)] == [None, "", "clean"]
    assert [r.spans for r in pii.op5(docs.filter("doc_id in (1, 2)")).collect()] == ["", ""]
    assert pii.op5(docs.limit(0)).collect() == []


# --- contamination -----------------------------------------------------------


def brute_hits(text, items):
    words, hit, names = words_of(text), set(), set()
    for item, t in items:
        for w in decontaminate.item_windows(t):
            for s in range(len(words) - len(w) + 1):
                if tuple(words[s : s + len(w)]) == w:
                    hit |= set(range(s, s + len(w)))
                    names.add(str(item))
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 150])
def test_contamination_equals_brute_force(spark, block_bytes):
    rng = random.Random(5)
    words = ["the", "of", "A1", "é", "ä-b", "x", "yy", "zz"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 4, 12, 25]))) for i in range(12)] + [(3, None), (None, "yy yy yy"), (4, "the the the")]
    texts = [text(rng.randint(0, 60)) for _ in range(40)] + [None, "", "!!", "The THE the", items[5][1], items[5][1]]
    texts += [text(5) + " " + t + " " + text(5) for _, t in items if t]
    docs = documents(spark, texts, n_words="x", Items=3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(docs, benchmark, ["doc_id"], block_bytes).collect()
    named = [(i, t) for i, t in items if i is not None]
    for r in found:
        n, hit, names = brute_hits(texts[r.doc_id], items)
        assert (r.n_words, sum(e - s for s, e in zip(r.span_starts, r.span_ends))) == (n, hit)
        assert r["items"] == brute_hits(texts[r.doc_id], named)[2]
    assert len(found) == len(texts)


def test_contamination_query_and_filter(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = documents(spark, [f"x {item.upper()} y", item[:30], None, f"{item} {item}"], span_starts=1)
    benchmark = spark.createDataFrame([(7, item), (10, item), (8, "")], "item_id int, text string")
    got = {r.doc_id: r for r in decontaminate.op10(docs, benchmark).collect()}
    assert [got[i].n_hit for i in range(4)] == [11, 0, 0, 22]
    assert got[0].items_sha256 == hashlib.sha256(b"10,7").hexdigest() and got[0].n_items == 2 and got[0].contaminated
    assert got[1].items_sha256 == hashlib.sha256(b"").hexdigest() and not got[1].contaminated
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert decontaminate.drop_contaminated(docs, benchmark.limit(0)).count() == 4
    assert decontaminate.op10(docs.limit(0), benchmark).count() == 0


# --- WARC ---------------------------------------------------------------------


@pytest.mark.parametrize("max_broadcast", [1000, 0])
def test_archives_round_trip(spark, tmp_path, max_broadcast, monkeypatch):
    big, small = "<p>é " + "x" * 1200, "<p>small"
    rows = [(1, "http://a/1", big), (5, None, big), (3, "http://a/\r\n3", big), (4, "u", small), (6, "u", small), (7, "u", None),
            (8, "u", big + "!"), (9, "u", big), (9, "u", big), (None, "u", big), (None, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    typed = warc_archive.with_record_types
    monkeypatch.setattr(warc_archive, "with_record_types", lambda p: typed(p, max_broadcast))
    manifest = warc_archive.write_archives(pages, str(tmp_path / "warc"))
    got = sorted((tuple(r) for r in warc_archive.read_archives(manifest).collect()), key=str)
    want = []
    for page, _, html in rows:
        payload = (html or "").encode()
        again = html == big and page != 9
        want.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", 9 if again else None))
    assert got == sorted(want, key=str)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)


def test_archive_format():
    records = [warc_archive.warc_record(i, f"http://x/{i}", b"<html>" + bytes([65 + i]) * 50, None) for i in range(20)]
    out = io.BytesIO()
    out.close = lambda: None
    writer = warc_archive.ArchiveWriter(out)
    for r in records:
        writer.add(r)
    writer.close()
    data = out.getvalue()
    assert int.from_bytes(data[:4], "little") == warc_archive.DICTIONARY_FRAME
    size = int.from_bytes(data[4:8], "little")
    shared = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    # Each record is a frame of its own.
    rest, frames = data[8 + size :], []
    while rest:
        d = zstandard.ZstdDecompressor(dict_data=shared).decompressobj()
        frames.append(d.decompress(rest))
        rest = d.unused_data
    assert frames == records
    assert [h["page-id"] for h, _ in warc_archive.read_archive(io.BytesIO(data))] == [str(i) for i in range(20)]


def test_empty_archive_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_archive.op8(empty).collect() == []


# --- packing -------------------------------------------------------------------


def test_token_ids_equal_the_tokenizer():
    _, reference = packing.tokenizer()
    rng = random.Random(2)
    texts = ["", "a", "<|endoftext|> b", "é" * 5, " \n\t x", "İ ﬁ ½ 한국 👍🏽", "x" * 5000]
    texts += ["".join(rng.choice("ab 1é\n'.,😀  ") for _ in range(rng.randint(1, 200))) for _ in range(300)]
    for t in texts:
        assert packing.token_ids(t).tolist() == [*reference.encode(t, add_special_tokens=False).ids, 0]
    assert packing.token_ids(None).tolist() == [0]


@pytest.mark.parametrize("shard_tokens", [packing.SHARD_TOKENS, 3000])
def test_every_token_is_packed_once(spark, sf_small, shard_tokens):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", F.lit(1).alias("offset"))
    docs = docs.unionByName(spark.createDataFrame([(-1, None, 0), (-2, "", 0), (None, "x", 0)], docs.schema))
    rows = packing.pack_documents(docs, shard_tokens=shard_tokens).toPandas()
    want = {r.doc_id: packing.token_ids(r.text) for r in docs.collect()}
    rows["doc_id"] = rows["doc_id"].astype(object).where(rows["doc_id"].notna(), None)
    for doc, ids in want.items():
        x = rows[rows.doc_id.isna()] if doc is None else rows[rows.doc_id == doc]
        x = x.sort_values("start")
        assert np.concatenate([np.frombuffer(b, "<u4") for b in x.ids]).tolist() == ids.tolist()
        assert x.start.tolist() == [0, *np.cumsum(x.length)[:-1]] and (x.doc_tokens == len(ids)).all()
        assert x.ids_crc32.tolist() == [zlib.crc32(b) for b in x.ids]
    for _, x in rows.sort_values("offset").groupby("sequence_id"):
        assert x.offset.tolist() == [0, *np.cumsum(x.length)[:-1]]
        total = int(x.length.sum())
        assert total <= packing.WINDOW and total & (total - 1) == 0
    assert packing.op4(docs.limit(0)).collect() == []


def test_neighbours_are_the_best_unused_by_bm25():
    rng = np.random.default_rng(1)
    docs = [np.append(rng.integers(1, 200, rng.integers(1, 60)), 0).astype("<u2") for _ in range(120)]
    df = np.zeros(packing.VOCABULARY)
    for d in docs:
        df[np.unique(d)] += 1
    idf, mean = packing.inverse_frequencies(df, len(docs)), float(np.mean([len(d) for d in docs]))
    index = packing.ShardIndex(docs, idf, mean)
    unused = rng.random(len(docs)) < 0.7

    def weight(t, d):
        tf = (docs[d][:-1] == t).sum()
        return idf[t] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(docs[d]) / mean)) if tf else 0

    for seed in range(0, 120, 10):
        terms = [t for t in set(docs[seed][:-1].tolist()) if sum(t in d[:-1] for d in docs) > 1]
        terms = sorted(terms, key=lambda t: (-weight(t, seed), t))[: packing.QUERY_TERMS]
        want = np.array([sum(weight(t, d) for t in terms) if unused[d] else 0 for d in range(len(docs))])
        got = index.neighbours(seed, unused)
        assert len(got) == min(packing.NEIGHBOURS, (want > 0).sum())
        assert np.allclose(want[got], np.sort(want)[::-1][: len(got)])


def test_related_documents_meet():
    a, b = np.arange(10, 400), np.arange(5000, 5400)
    docs = [np.append(x, 0).astype("<u2") for x in (a, b, a[:300], b[:300])]
    df = np.zeros(packing.VOCABULARY)
    for d in docs:
        df[np.unique(d)] += 1
    order = packing.packing_order(docs, packing.inverse_frequencies(df, 4), 300.0)
    assert order.index(2) == order.index(0) + 1 and order.index(3) == order.index(1) + 1
