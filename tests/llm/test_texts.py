"""Classifiers, tokens, pages, urls and tool calls."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cartwise.llm import op1_quality as quality
from cartwise.llm import op2_main_text as pages
from cartwise.llm import op4_bpe as bpe
from cartwise.llm import op6_language as language
from cartwise.llm import op8_tool_calls as tools
from cartwise.llm import op9_url_filter as urls
from cartwise.llm import op10_token_counts as counts

SF_DIR = "/root/testdata/sf0.01"
RANKS = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PIECES = ["a", " ", "  ", "\n", "\t ", "'s", "É", "1", "½", "!!", "hello", " World", "東京", " ", " ", "😀", "Ᲊ", "x" * 40, "'ll", "\x00", "<|endoftext|>"]


def odd_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randrange(30))) for _ in range(n)]


def test_quality_on_held_out_labels(spark):
    found = quality.op1_quality(spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").where("held_out")
    right = found.where("(score >= 0.5) = (quality = 1)").count()
    assert right >= 0.93 * found.count() > 50
    assert found.where("quality = 1 and predicted = 0").count() <= 1


def test_quality_of_odd_rows(spark, make):
    docs = make([(1, None, 9), (2, "", 9), (None, "good words here", 9), (3, "x " * 300_000, 9)] * 2, "doc_id long, text string, quality int")
    labels = make([(2, 0, "t"), (3, 1, "t"), (3, 1, "t"), (1, 1, "t"), (None, 1, "t"), (2, None, "t")], "doc_id long, quality int, text string")
    found = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(found) == 8 and all(0 <= r.quality_score <= 1 for r in found)
    none = make([], "doc_id long, text string"), make([], "doc_id long, quality int")
    weights = quality.fit(docs, none[1])
    assert {r.quality_score for r in quality.score(docs, weights).collect()} == {0.5}
    assert quality.score(none[0], quality.fit(*none)).count() == 0
    ones = quality.fit(docs, make([(2, 1)], "doc_id long, quality int"))
    assert quality.score(docs, ones).first().quality_score > 0.99


def test_quality_fit_is_bounded_and_repeatable(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    a, b = (quality.fit(docs, labels, max_rows=100) for _ in range(2))
    assert np.array_equal(a, b)


def test_language_on_held_out_documents(spark):
    found = language.op6_language(spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.98 * found.count()


def test_language_of_odd_rows(make):
    learn = make([("the cat and the dog", "en"), ("le chat et le chien", "fr"), (None, "xx"), ("huh", None), ("12", "yy")], "text string, lang string")
    known = language.fit(learn)
    assert sorted(known) == ["en", "fr"]
    texts = [None, "", "12 !", "the dog", "LE CHIEN", "東京", "the " * 200_000]
    docs = make([(i, t, "zz") for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string")
    found = {r.doc_id: (r.lang_pred, r.lang_score) for r in language.predict(docs.drop("lang_pred"), known).collect()}
    assert [found[i][0] for i in range(5)] == ["und", "und", "und", "en", "fr"]
    assert found[5][0] in known and found[6][0] == "en" and all(0 <= s <= 1 for _, s in found.values())
    nothing = language.fit(learn.limit(0))
    assert {r.lang_pred for r in language.predict(docs.drop("lang_pred"), nothing).collect()} == {"und"}
    assert language.predict(docs.drop("lang_pred").limit(0), known).count() == 0


def test_language_vectors_begin_anew_when_full(monkeypatch):
    codes = np.unique(language._grams("the quick brown fox jumps over the lazy dog again and again"))
    whole = language._Vectors().bundle(codes, np.ones(len(codes)))
    small = language._Vectors()
    small.LIMIT = len(codes)
    small.places(np.unique(language._grams("zebra crossing")))
    assert np.array_equal(small.bundle(codes, np.ones(len(codes))), whole)


@pytest.mark.parametrize("repeats", [1, 16])
def test_bpe_is_what_tiktoken_does(make, monkeypatch, repeats):
    monkeypatch.setattr(bpe, "REPEATS", repeats)
    monkeypatch.setattr(bpe, "BLOCK_PIECES", 200)
    monkeypatch.setattr(bpe, "WORDS_HELD", 150)
    texts = [*odd_texts(2, 120), None, "", "the the " * 3000, "y" * 2000]
    docs = make([(i, t, b"x", 0) for i, t in enumerate(texts)] + [(0, texts[0], b"x", 0)], "doc_id long, text string, ids binary, codes int")
    found = bpe.decode(bpe.encode(docs)).collect()
    once = bpe.encode(docs, decoded=True).collect()
    assert sorted((r.doc_id, r.ids, r.decoded) for r in once) == sorted((r.doc_id, r.ids, r.decoded) for r in found)
    assert len(found) == len(texts) + 1
    for r in found:
        text = texts[r.doc_id] or ""
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == TIKTOKEN.encode_ordinary(text), text
        assert bytes(r.decoded) == text.encode()


def test_bpe_of_no_rows_and_unknown_ids(make):
    assert bpe.decode(bpe.encode(make([], "doc_id long, text string"))).count() == 0
    ids = make([(np.array([60_000], "<u4").tobytes(),), (None,), (b"",)], "ids binary")
    assert [r.decoded for r in bpe.decode(ids).collect()] == [None, None, bytearray()]


def test_bpe_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in bpe.op4_bpe(spark, "/root/testdata/sf0.001").collect():
        ids = np.array(TIKTOKEN.encode_ordinary(docs[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("leaf", [1, 3, 128])
def test_edits_count_as_encoding_anew(monkeypatch, leaf):
    monkeypatch.setattr(counts, "LEAF", leaf)
    rng, counter = random.Random(leaf), counts.Counter()
    for text in odd_texts(leaf, 150):
        tree = counts.Tree(counter, counter.pattern.findall(text))
        for _ in range(6):
            start = rng.randint(-2, len(text) + 3)
            stop, put = start + rng.randint(-2, 9), "".join(rng.choices(PIECES, k=rng.randrange(4)))
            a = min(max(start, 0), len(text))
            text = text[:a] + put + text[min(max(stop, a), len(text)) :]
            tree.edit(start, stop, put)
            assert tree.words() == counter.pattern.findall(text)
            assert tree.total == sum(tree.counts()) == len(TIKTOKEN.encode_ordinary(text))


def test_an_edit_touches_little(make):
    tree = counts.Tree(counter := counts.Counter(), counter.pattern.findall("some words and others " * 5000))
    tree.edit(50_000, 50_003, "new")
    assert tree.encoded <= 5


def test_recount_in_rounds_and_odd_rows(make, monkeypatch):
    monkeypatch.setattr(counts, "EDITS_PER_ROUND", 3)
    docs = make([(1, "hello world", 0), (2, None, 0), (3, "", 0), (None, "a b", 0), (1, "hello world", 0)], "doc_id long, text string, words int")
    edits = [(1, n, 5, 5, " x") for n in range(8)] + [(2, 1, None, None, "abc"), (3, 1, 4, 9, None), (None, 1, 0, 1, "z"), (77, 1, 0, 0, "z")]
    found = counts.recount(docs, make(edits, "doc_id long, seq int, start int, stop int, insert string")).collect()
    got = sorted((r.doc_id or 0, "".join(r.words), r.total) for r in found)
    long = "hello" + " x" * 8 + " world"
    n = lambda t: len(TIKTOKEN.encode_ordinary(t))
    assert got == [(0, "a b", n("a b")), (1, long, n(long)), (1, long, n(long)), (2, "abc", n("abc")), (3, "", 0)]
    assert counts.recount(docs.limit(0), make([], "doc_id long, seq int, start int, stop int, insert string")).count() == 0


def test_token_counts_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in counts.op10_token_counts(spark, sf_dir).collect():
        t = texts[r.doc_id]
        a = t[: len(t) // 2] + t[int(len(t) / 2 + len(t) / 16) :]
        b = f"{a[: int(len(a) / 3)]} {r.doc_id}{a[int(len(a) / 3) :]}"
        assert (r.n_tokens_before, r.n_tokens) == tuple(len(TIKTOKEN.encode_ordinary(x)) for x in (t, b[:-1] + "! "))


SITE = """<!DOCTYPE html><html><head><title>T{n}</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/x>X{n}</a></ul></nav><div class="cookie-notice">We bake {n}</div>
<div class=content><h2>Head {n}</h2><p>First&nbsp;&amp; {n}<br>line <b>bo</b>ld<p>Second {n}<p class=x>Follow us everywhere</div>
<form><input><button>Go</button>Find {n}</form><aside>Side {n}</aside><div id="comments"><p>Nice {n}</div><footer>Foot {n}</footer></body></html>"""


def test_main_text_by_wrapper(make):
    rows = [(n, "http://a.example/1", SITE.format(n=n), "u") for n in range(20)]
    rows += [(50, "http://b.example/", "<p>One page", "u"), (51, None, None, "u"), (52, "http://b.example/", "", "u"), (53, "x", "<div" + "<b>" * 3000 + "deep", "u")]
    rows += [(54, "http://c.example/", "<article><p>A</p>B<article class=comment>C</article></article><p>D", "u")]
    found = {r.page_id: r.main_text for r in pages.extract(make(rows, "page_id long, url string, html string, host string")).collect()}
    # "Follow us everywhere" is the same on all pages of the host, so it is template.
    assert all(found[n] == f"Head {n} First & {n} line bold Second {n}" for n in range(20))
    assert (found[50], found[51], found[52], found[54]) == ("One page", "", "", "A B")
    assert "deep" in found[53]
    assert pages.extract(make([], "page_id long, url string, html string")).count() == 0


def test_main_text_of_deep_pages():
    nest = "<div>" * 70 + "deep<nav>menu</nav><script>code</script> text" + "</div>" * 70
    page = f"<div id=page><article><p>before</p>{nest}<p>after</p></article><p>outside</div>"
    assert pages.main_text(pages.parse(page), None) == "before deep text after"
    deep = "<div>" * 70 + "gone<article>here<nav>no</nav><b>!</b></article>" + "</div>" * 70 + "<p>gone"
    assert pages.main_text(pages.parse(deep), None) == "here!"
    assert pages.main_text(pages.parse("<div>" * 5000 + "a<div>b</div>" + "</div>" * 5000 + "c"), None) == "a b c"


def texts_of(make, bodies):
    rows = [(n, f"http://one.example/{n}", b) for n, b in enumerate(bodies)]
    return {r.page_id: r.main_text for r in pages.extract(make(rows, "page_id long, url string, html string")).collect()}


def test_constant_block_among_like_siblings(make):
    body = "<div><h2>Head {n}</h2>{more}<p>Text {n}<p>Subscribe to our newsletter</div><ul><li>One {n}<li>Always</ul>"
    found = texts_of(make, [body.format(n=n, more=f"<p>More {n}<h2>Sub {n}</h2>" * (n % 4)) for n in range(20)])
    for n in range(20):
        assert found[n] == f"Head {n} " + f"More {n} Sub {n} " * (n % 4) + f"Text {n} One {n}"


def test_template_does_not_depend_on_order(make):
    for odd in (0, 7, 19):
        bodies = [f"<div><p class=x>{'Odd' if n == odd else 'Always'}</p><p>Text {n}</div>" for n in range(20)]
        # Repeats of one page are one page.
        found = texts_of(make, bodies + [bodies[3]] * 40)
        assert all(found[n] == (f"Odd Text {n}" if n == odd else f"Text {n}") for n in range(20))
        assert all(found[n] == "Text 3" for n in range(20, 60))


def test_varying_text_chooses_content(make):
    menu = "<nav><a href=/>Item {n}</a></nav>"
    long = "Long varying words of page {n}, many more than elsewhere."
    side = texts_of(make, [(menu + f"<div class=widget><p>{long}</p></div>").format(n=n) for n in range(10)])
    card = texts_of(make, [(menu + f"<article>Card {{n}}</article><div><p>{long}</p></div>").format(n=n) for n in range(10)])
    for n in range(10):
        assert side[n] == long.format(n=n)
        assert card[n] == f"Card {n} " + long.format(n=n)
    few = "<div class='layout sidebar-right'><nav>menu</nav><article>Kept</article><p>no</div>"
    assert pages.main_text(pages.parse(few), None) == "Kept"


def test_main_text_with_wrappers_joined(make, monkeypatch):
    rows = [(n, f"http://h{n % 2}.example/", SITE.format(n=n)) for n in range(24)]
    frame = make(rows, "page_id long, url string, html string")
    sent = sorted(tuple(r) for r in pages.extract(frame).collect())
    monkeypatch.setattr(pages, "SENT_BYTES", 0)
    assert sorted(tuple(r) for r in pages.extract(frame).collect()) == sent


def test_tree_matching_keeps_order():
    a, b = ([["x", 1, 0, 0, []], ["y", 1, 0, 0, []], ["z", 1, 0, 0, []]], [["y", 1, 0, 0, []], ["x", 1, 0, 0, []], ["z", 1, 0, 0, []]])
    score, pairs = pages._matching(a, b)
    assert score == 2 and len(pairs) == 2


def test_url_filter(make, spark):
    given = [
        None, "", "nothing", "http://", "http://a.NET", "http://a.net/", "HTTP://A.Example.NET/en/x?y#z", "http://example.net/en",
        "http://example.com/de/", "http://notexample.com/de/", "http://x.org/fr/?q=http://a.net/", "://net/", "http://net?x/", "http://net:80/", "é://É.net/é",
    ]
    frame = make([(i, u, "h") for i, u in enumerate(given)] + [(5, given[5], "h")], "page_id long, url string, host string")
    found = {r.page_id: r for r in urls.judge(frame).collect()}

    def plain(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fits)[1:] if fits else (None, "allow")))

    for i, url in enumerate(given):
        assert tuple(found[i])[1:] == plain(url), url
    assert urls.judge(frame).count() == len(given) + 1
    assert urls.judge(frame.limit(0)).count() == 0
    assert {r.verdict for r in urls.judge(frame, rules=()).collect()} == {"allow"}


def test_cascade_is_exact_with_many_keys(spark):
    universe = spark.range(20_000).selectExpr("concat('k', id % 15000) AS key")
    listed = spark.range(0, 30_000, 37).selectExpr("concat('k', id) AS key")
    cascade = urls.Cascade(universe, 15_000, listed, 1)
    wrong = universe.distinct().join(listed.selectExpr("key", "true AS there"), "key", "left")
    assert len(cascade.levels) > 1
    assert wrong.where(cascade.has(wrong.key) != wrong.there.isNotNull()).count() == 0


CALLS = "conv_id long, call_id string, turn long, name string, arguments string, depends array<string>, json string"


@pytest.mark.parametrize("small", [0, 20_000])
def test_levels_of_chains_and_diamonds(make, monkeypatch, small):
    monkeypatch.setattr(tools, "EDGES_OF_A_SMALL", small)
    rows = [(1, str(i), [str(i - 1)] if i else None) for i in range(12)]
    rows += [(2, "a", []), (2, "b", ["a"]), (2, "c", ["a", "b"]), (2, "d", ["a", "c", "gone"]), (3, "x", ["y"]), (3, "y", ["x"]), (3, "z", ["x"])]
    found = {(r.conv_id, r.call_id): r.level for r in tools.levels(make(rows, "conv_id long, call_id string, depends array<string>")).collect()}
    want = {(1, str(i)): i + 1 for i in range(12)} | {(2, c): n for n, c in enumerate("abcd", 1)} | {(3, c): -1 for c in "xyz"}
    assert found == want


def test_tool_calls(make):
    calls = make(
        [
            (1, "a", 1, "ask", '{"words": 3.0, "text": "é\\n"}', None, "c"),
            (1, "b", 3, "ask", '{"text": "", "words": 99}', ["a", "zz"], "c"),
            (1, "c", 2, "ask", "{", ["b", "a"], "c"),
            (1, "d", 4, "none", "{}", ["e"], "c"),
            (1, "e", 5, "ask", None, ["d"], "c"),
            (2, "a", 1, "ask", '{"text": "t", "words": 1, "more": NaN}', [], "c"),
            (2, "a", 1, "ask", '{"text": "t", "words": 1, "more": NaN}', [], "c"),
            (None, "a", 1, "ask", "{}", [], "c"),
        ],
        CALLS,
    )
    results = make(
        [(1, "a", 2, "second"), (1, "a", 2, "first"), (2, "q", 1, None), (1, "b", 9, None), (None, "a", 1, "x"), (1, None, 1, "x")],
        "conv_id long, call_id string, turn long, content string",
    )
    found = {(r.conv_id, r.call_id): r for r in tools.link(calls, results).collect()}
    assert {k: (r.level, r.status, r.n_results) for k, r in found.items()} == {
        (1, "a"): (1, "linked", 2), (1, "b"): (2, "linked", 1), (1, "c"): (3, "open", 0), (1, "d"): (-1, "open", 0),
        (1, "e"): (-1, "open", 0), (2, "a"): (1, "open", 0), (2, "q"): (None, "orphan", 1),
    }
    a = found[1, "a"]
    assert not a.valid and a.errors == ["$.words: not integer"]
    assert a.json == '{"arguments":{"text":"é\\n","words":3},"id":"a","level":1,"name":"ask","result":"first","status":"linked"}'
    assert found[1, "b"].errors == ["$.text: too short", "$.words: too large", "unknown dependency"]
    assert found[1, "d"].errors == ["no schema", "cycle"] and found[1, "e"].errors == ["arguments are not JSON", "cycle"]
    assert json.loads(found[2, "q"].json)["result"] is None
    empty = tools.link(make([], CALLS), make([], "conv_id long, call_id string, turn long, content string"))
    assert empty.count() == 0


def test_schema_keywords():
    schema = {"type": ["array", "null"], "items": {"enum": [1, "a"]}}
    assert tools.schema_errors([1, "a", 2], schema) == ["$[2]: not in enum"]
    assert tools.schema_errors(None, schema) == [] and tools.schema_errors({}, schema) == ["$: not ['array', 'null']"]
    assert tools.schema_errors({"x": "abc"}, {"properties": {"x": {"maxLength": 2}}}) == ["$.x: too long"]
    assert tools.canonical({"b": [1.0, 1.5], "a": {"d": None, "c": True}}) == '{"a":{"c":true,"d":null},"b":[1,1.5]}'


def test_fold_is_crc32(make):
    from cartwise.llm import common

    ids = [0, 7, -3, 10**12, None]
    got = [r[0] for r in make([(i,) for i in ids], "doc_id long").select(common.fold_of(common.F.col("doc_id"), 5)).collect()]
    assert got == [-1 if i is None else zlib.crc32(str(i).encode()) % 5 for i in ids]


def test_ids_as_text_round_trip():
    ids = np.array(TIKTOKEN.encode_ordinary("round trip"), "<u4")
    assert np.frombuffer(base64.b64decode(base64.b64encode(ids.tobytes())), "<u4").tolist() == ids.tolist()


def test_tool_calls_with_arguments_that_no_text_can_hold(make):
    """Deep nesting, numbers out of range and lone surrogates are no JSON; the job goes on."""
    given = ["[" * 3000 + "]" * 3000, '{"words":1e400}', '{"text":"\\ud800"}', '{"words":-1e999}', "[" * 200_000, '{"text":"a","words":3}']
    calls = make([(1, f"c{i}", i, "ask", a, None) for i, a in enumerate(given)], "conv_id long, call_id string, turn int, name string, arguments string, depends array<string>")
    results = make([], "conv_id long, call_id string, turn int, content string")
    found = {r.call_id: r for r in tools.link(calls, results).collect()}
    for i in range(5):
        assert list(found[f"c{i}"].errors) == ["arguments are not JSON"] and not found[f"c{i}"].valid
        assert json.loads(found[f"c{i}"].json)["arguments"] == given[i]
    assert found["c5"].valid and json.loads(found["c5"].json)["arguments"] == {"text": "a", "words": 3}
