"""Vectors, archives, pages, conversations, components, and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clinistar.llm import ann, chat, html_text, queries, warc
from clinistar.llm.common import table
from clinistar.llm.components import components

SF = "/root/testdata/sf0.001"


# --- 4 -------------------------------------------------------------------
def brute_search(data, is_query, k):
    ok = {}
    for i, v in data:
        if i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        ok[i] = max(ok.get(i, v), v)
    out = []
    for q, x in ok.items():
        if is_query(q):
            near = sorted((-float(np.cumsum(np.array(x, float) * np.array(y, float))[-1]), i) for i, y in ok.items() if i != q and len(y) == len(x))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near[:k])]
    return sorted(out)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "CANDIDATES", 64)
    monkeypatch.setattr(ann, "QUERIES", 16)
    rng = np.random.default_rng(4)
    data = [(int(i), [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(400)]
    data += [(1000 + i, [1.0] * 8) for i in range(90)]  # ties
    data += [(None, [1.0] * 8), (2000, None), (2001, []), (2002, [0.0] * 8), (2003, [float("nan")] + [1.0] * 7), (2004, [None] + [1.0] * 7),
             (2005, [float("inf")] + [1.0] * 7), (2010, [1e-30] * 8), (2020, [1e30] * 8), (5, [9.0] * 8), (20, data[20][1]), (3000, [1.0, 2.0]), (3010, [2.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in data], "vec_id long, embedding array<double>, block int, ids string")
    got = ann.search(df, F.col("vec_id") % 10 == 0, 7)
    assert sorted(tuple(r) for r in got.collect()) == brute_search(data, lambda i: i % 10 == 0, 7)
    assert ann.search(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert ann.search(df, F.lit(False)).count() == 0


def test_quantisation_bound_holds():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(50, 1500)), rng.normal(size=(60, 1500)) * 100
    (a, s, r), (b, t, q) = ann.quantise(x), ann.quantise(y)
    near = ann.products(a, b) * s[:, None] * t[None, :]
    assert (ann.products(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()
    bound = np.linalg.norm(x, axis=1)[:, None] * q[None, :] + r[:, None] * (np.linalg.norm(y, axis=1) + q)[None, :]
    assert (np.abs(x @ y.T - near) <= bound * (1 + 1e-9)).all()


# --- 5 -------------------------------------------------------------------
PAGES = "page_id long, url string, html string, payload string, part int"


def pages(spark, data):
    return spark.createDataFrame([(i, u, h, "p", 1) for i, u, h in data], PAGES)


def test_warc_round_trip(spark):
    big = "".join(random.Random(1).choices("abc<>é\r\n", k=400_000))
    data = [(1, "http://a/", "same"), (2, "http://b/\r\nX: y %41", "same"), (3, None, "same"), (4, "u", ""), (5, "u", None), (6, "u", big),
            (None, "u", "alone"), (None, "u", "same"), (7, "u", "WARC/1.1\r\n\r\n"), (3, None, "same")]
    got = warc.round_trip(pages(spark, data)).collect()
    top = {}
    for i, _, h in data:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)

    def want(i, h):
        p, best = (h or "").encode(), top[h or ""]
        first = best == (-1 if i is None else i)
        return (i is None, i or 0, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if first else "revisit", 0 if first else best)

    assert sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0) for r in got) == sorted(want(i, h) for i, _, h in data)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_warc_reader_verifies():
    good = warc.member("1", "http://x/", b"payload" * 30_000, None) + warc.member("2", None, b"payload", "1")
    first, second = warc.records(io.BytesIO(good), keep_payload=True)
    assert first.payload == b"payload" * 30_000 and (second.type, second.refers_to, second.payload_bytes) == ("revisit", "1", 7)
    raw = zlib.decompress(warc.member("1", None, b"abc", None), 31)

    def packed(data):
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        return z.compress(data) + z.flush()

    for broken in (raw.replace(b"abc", b"abd"), raw.replace(b"Content-Length: ", b"Content-Length: 1"), raw + b"x", raw[:-4], raw[:20]):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(packed(broken))))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(good[:-9])))


def test_warc_least_revisit(spark):
    got = warc.round_trip(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]), least=3)
    assert {r.page_id: r.record_type for r in got.collect()} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


# --- 6 -------------------------------------------------------------------
def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def read(spark, data):
    return {r.page_id: r.text for r in html_text.extract(pages(spark, data)).collect()}


def test_main_text_of_articles(spark):
    body = ('<header class="top"><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li><li>B</li></ul></nav><div class="ad">Buy</div>'
            '<article><header><h1>Title &amp; more</h1></header><p>One <b>two\n three<p>Four&nbsp;five<br>six</p><script>var x="<p>no</p>";</script>'
            '<aside>Related</aside><form>Sign <p>up</p></form><ul><li>item</li><li>item two</li></ul><div class="comments"><p>I say</p></div></article>'
            '<div class="cookie-notice">We use</div><footer>&copy; x</footer><!-- <article>no</article> --><div hidden>never</div>')
    got = read(spark, [(i, f"http://h/{i}", page(body.replace("Four", f"Four{i}"))) for i in range(6)])
    assert got[3] == "Title & more\nOne two three\nFour3 five six\nitem\nitem two"


def test_main_text_without_an_article(spark):
    def body(i):
        text = "".join(f"<p>Sentence {k} of page {i} says something of its own.</p>" for k in range(2 + i))
        return f'<div id="top">Always here</div><div class="sidebar"><p>Side {i}</p></div><div class="content">{text}</div><div><a href="#">more like {i}</a></div>'

    got = read(spark, [(i, "https://user@Host.org:80/x", page(body(i))) for i in range(6)])
    assert got[1] == "\n".join(f"Sentence {k} of page 1 says something of its own." for k in range(3))


def test_articles_and_other_templates_on_one_host(spark):
    article = lambda i: f'<div class="lead">Lead {"long " * 200}{i}</div><article><p>Article {i}</p></article>'
    other = lambda i: f'<div class="lead">Lead {i}</div><div class="content"><p>Content {i} is told in a text of its own.</p></div>'
    for host in ("http://h/", None):
        got = read(spark, [(i, host, page(article(i) if i % 2 else other(i))) for i in range(12)])
        assert got == {i: f"Article {i}" if i % 2 else f"Content {i} is told in a text of its own." for i in range(12)}


def test_two_layouts_on_one_host(spark):
    body = lambda i: f'<div class="{"post" if i % 5 == 0 else "story"}"><p>Page {i} tells {"much " * 30}of its own.</p></div><div class="info">About {i}</div>'
    got = read(spark, [(i, "http://h/", page(body(i))) for i in range(40)])
    assert got == {i: f"Page {i} tells {'much ' * 30}of its own." for i in range(40)}


def test_copies_are_no_template(spark):
    top = '<div class="top">On every page of this host</div>'
    data = [(i, "http://h/", page(f'{top}<div class="story"><p>Page {i} tells {"much " * 30}</p></div>')) for i in range(20)]
    data += [(100 + i, "http://h/", page(f'{top}<div class="story"><div class="copy">The same text in six copies of a page.</div></div>')) for i in range(6)]
    got = read(spark, data)
    assert all(got[100 + i] == "The same text in six copies of a page." for i in range(6))
    assert all(got[i] == f"Page {i} tells {'much ' * 30}".strip() for i in range(20))


def test_bounded_wrapper_keeps_all_figures(spark, monkeypatch):
    word = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    def body(i):
        rows = "".join(f"<p>Line {k} of page {i} tells a little</p>" for k in range(3 + i % 4))
        mixed = "".join(f'<section class="{word(i % 29 * 7 + k)}"><h2>Head {k} {i}</h2><p>a {i}</p><p>b {k}</p></section>' for k in range(6))
        return f'<div class="info">About {i}</div><div class="story"><div class="{word(i % 29)}">{rows}</div>{mixed}</div>'

    monkeypatch.setattr(html_text, "NODES", 40)
    streams = {i: html_text.tokens(page(body(i))) for i in range(120)}
    chars, wrapper = {}, html_text.Wrappers()
    for i in range(120):
        wrapper.add("h", page(body(i)))
        for n in streams[i][0]:
            if n.path is not None:
                chars[n.path] = chars.get(n.path, 0) + n.chars
    halves = [html_text.Wrappers(), html_text.Wrappers()]
    for i in range(120):
        halves[i % 2].add("h", page(body(i)))
    for nodes in (wrapper.of["h"], html_text.merged(*[w.of["h"] for w in halves])):
        held = {}
        for s in html_text.slots(nodes):
            held[s.path] = held.get(s.path, 0) + s.chars
        assert held == chars
        reader = html_text.Reader(html_text.json.dumps([n.plain() for n in nodes]))
        for i in range(120):
            text = reader.text(page(body(i)))
            assert text == "\n".join(t for t in streams[i][1] if t not in ("T", f"About {i}"))


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "<p>deep" + "</div>" * 3000
    data = [(1, None, None), (2, "not a url", ""), (3, "http://h/", "plain text only"), (4, "http://h/", '<a href="'), (5, "http://h/", "<article><p>cut off &am"),
            (6, "http://h/", "<!-- never closed <p>x"), (None, "http://h/", "<main>" + "<p>x y</p>" * 20_000 + "</main>"), (7, "http://d/", deep), (7, "http://d/", deep)]
    rows = html_text.extract(pages(spark, data)).collect()
    assert len(rows) == len(data)
    by = {r.page_id: r.text for r in rows}
    assert by[1] == by[2] == by[6] == "" and by[5] == "cut off &am" and by[None].count("\n") == 19_999
    assert all(r.n_chars == len(r.text) for r in rows)
    assert html_text.extract(pages(spark, [])).count() == 0


def test_wrapper_is_inferred_by_alignment():
    w = html_text.Wrappers()
    for i, extra in enumerate(("", "<div class='x'>now and then</div>", "")):
        w.add("h", f"<body><ul>{'<li>a' + str(i) + '</li>' * 1}{'<li>b</li>' * i}</ul><p>same</p>{extra}<p>text {i}</p></body>")
    keys = [("?" if n.optional else "") + n.key for n in w.of["h"]]
    assert any(k.startswith("(<li") and k.endswith(")+") for k in keys)
    assert "?<div.x" in keys and "<ul" in keys
    merged = html_text.merged(*[html_text.fold(html_text.tokens(f"<body><h1>{t}</h1>")[0]) for t in "ab"])
    assert [n.same for n in html_text.slots(merged)] == [None]


# --- 10 ------------------------------------------------------------------
TURNS = "conv_id long, turn long, role string, text string, window int, start string"


def brute_chat(data):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    convs = {}
    for c, n, r, t in sorted(data, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        convs.setdefault(c, []).append((r or "", t or ""))
    return {c: (len(v), sha("".join(f"{r}\n{t}\n" for r, t in v)), sum(len(t) for r, t in v if r == "assistant"), sha("".join(t for r, t in v if r == "assistant"))) for c, v in convs.items()}


def test_chat_reads_back(spark):
    rng = random.Random(7)
    hard = ["\\", "###", "</turn>", "### Assistant: ", "####", "\\###", ": ", "\n", "", None, "word " * 30, "x" * 5000, "é😀"]
    data = [(c, n, rng.choice(["user", "assistant", "system", None, "to: ol\\"]) if n else "system", "".join(filter(None, rng.choices(hard, k=3))))
            for c in (1, 2, None) for n in range(12)]
    data += [(3, n, "assistant" if n % 2 else "user", f"turn {n} " * rng.randrange(1, 40)) for n in range(900)]
    data += [(4, None, "user", None), (4, None, "assistant", "late"), (5, 1, "assistant", "same"), (5, 1, "assistant", "same")]
    df = spark.createDataFrame([(*x, 1, "s") for x in data], TURNS)
    w = chat.windows(df.select("conv_id", "turn", "role", "text"))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.windows(df)).collect()}
    assert got == brute_chat(data)
    third = w.where("conv_id = 3")
    assert third.agg(F.max("n_tokens")).first()[0] <= chat.BUDGET and third.count() > 5
    assert w.where("conv_id = 1 and window > 0").count() == w.where("conv_id = 1 and window > 0 and formatted like '### system: %'").count()
    again = third.where("window > 0 and fresh > 0").count()
    assert again >= third.count() - 2  # history is repeated
    assert chat.read_back(chat.windows(df.limit(0))).count() == 0


def test_chat_history_is_whole(spark):
    rng = random.Random(3)
    role = lambda n: "assistant" if n % 2 == 0 else "user"
    size = {1: lambda n: 390 if n == 0 else 420 if n == 7 else rng.randrange(1, 40), 2: lambda n: 300 if n % 4 == 1 else rng.randrange(1, 90)}
    convs = {c: [("system" if n == 0 else role(n), " ".join([f"t{n}x"] + ["word"] * size[c](n))) for n in range(60)] for c in size}
    df = spark.createDataFrame([(c, n, r, t, 1, "s") for c, v in convs.items() for n, (r, t) in enumerate(v)], TURNS)
    for row in chat.windows(df).collect():
        turns = convs[row.conv_id]
        sizes = [len(chat.re.findall(r"[a-z]+|[0-9]+", t)) + chat.MARKS for _, t in turns]
        line = [sum(sizes[1:n]) for n in range(60)]
        stretch = max(chat.LEAST_NEW, chat.BUDGET - sizes[0] - max(chat.HISTORY, max(sizes)) - max(sizes))
        new = [n for n in range(1, 60) if line[n] // stretch == row.window]
        old = [n for n in range(1, new[0]) if line[n] >= row.window * stretch - chat.HISTORY or n == new[0] - 1]
        assert [*chat.parse(row.formatted)] == [turns[n] for n in (0, *old, *new)]
        if row.window:
            assert [*chat.parse(row.formatted[row.fresh :])] == [turns[n] for n in new]


# --- helpers and pipeline --------------------------------------------------
def test_components(spark):
    links = [(5, 4), (4, 3), (3, 2), (9, 8), (7, 7), (8, 9), *((100 + i, 101 + i) for i in range(60))]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {2: 2, 3: 2, 4: 2, 5: 2, 8: 8, 9: 8} | {100 + i: 100 for i in range(61)}


def test_every_dealt_query_is_registered():
    names = {n.split("_")[0] for n in queries.queries()}
    assert names == {f"op{i}" for i in range(1, 14)}
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        now = docs.select("doc_id", "text").collect()
        assert now and all(before[r.doc_id] == r.text for r in now)
        if name != "mix":
            assert len({r.doc_id for r in now}) == len(now)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() == corpus_pipeline.run(spark, SF).count()


def test_pipeline_on_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), f"test-{name}")
        assert docs.count() == 0
