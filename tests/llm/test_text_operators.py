"""Operators 3, 4, 5, 6, 8 and 9 and the pipeline on small inputs."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from strata.llm import html_text, language_id, one_bit_search, sentence_piece, suffix_dedup, token_files, url_rank
from strata.llm.common import table

from . import brute

TEXTS = [None, "", " ", "\nfirst", "\n", "a\n", "\n b", "a \n\n b\n", "a  b", "Hello, world!\nNew line.", "漢字 and é", "tab\tand\r\nreturn", "x" * 200, "  two", "end  ",
         "don't 123 <|endoftext|>", "Ungewöhnlich lange Wörter", "a" * 50 + " " + "the " * 30]


# ------------------------------------------------------------------- op 3

@pytest.fixture(scope="module")
def pieces():
    return sentence_piece.Pieces.load(sentence_piece.default_model())


def unigram_library():
    """The library's unigram encoder over the same pieces and scores."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece
    model = pb.ModelProto()
    with open(sentence_piece.default_model(), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def score(pieces, ids):
    by_id = {i: s for i, s in pieces.normal.values()}
    return sum(by_id[i] for i in ids)


def test_lattice_matches_the_recurrence(frame, pieces):
    rows = list(enumerate(TEXTS * 2))
    got = {r.doc_id: r for r in sentence_piece.encode(frame(rows)).collect()}
    for i, t in rows:
        assert got[i].ids == [x for w in pieces.words(t or "") for x in pieces.best_path(w)]
        assert got[i].round_trip and got[i].text == t and got[i].uid == "u"
        assert pieces.decode(got[i].ids) == (t or "")


def test_units_do_not_change_the_best_path(pieces):
    rng = random.Random(1)
    for _ in range(300):
        word = "".join(rng.choices("▁abcthe.,é漢\n'", k=rng.randrange(1, 14)))
        cut = [i for u in pieces.units(word) for i in pieces.best_path(u)]
        assert cut == pieces.best_path(word)


def test_paths_score_as_the_library(pieces):
    library = unigram_library()
    for text in ("the quick brown fox", "unbelievable characterization", "information retrieval", "wonderful indivisibility"):
        own = [i for w in pieces.words(text) for i in pieces.best_path(w)]
        theirs = library.nbest_encode(text, nbest_size=2)[0]
        assert score(pieces, own) == score(pieces, theirs) and library.decode(own) == text


def test_both_ways_to_words_agree(pieces):
    rng = random.Random(7)
    for _ in range(3000):
        text = "".join(rng.choices("ab \n.▁é", weights=[4, 4, 3, 2, 1, 0.2, 1], k=rng.randrange(1, 12)))
        words = pieces.quick_words(text)
        if words is not None:
            assert "".join(map(sentence_piece._marked, words)) == "".join(pieces.words(text))
        coder = sentence_piece.Coder(pieces)
        (code,), (same,) = coder.encode([text])
        assert list(memoryview(code).cast("i")) == [i for w in pieces.words(text) for i in pieces.best_path(w)]
        assert same == (sentence_piece.SPACE not in text)


def test_sql_lattice_alone(llm, pieces):
    units = llm.createDataFrame([(w, [1]) for w in ("▁the", "▁漢é", "x", "\n", "▁information", "😀", "ab漢cd")], "unit string, blocks array<long>")
    for r in sentence_piece.lattice(units, pieces, "blocks").collect():
        assert r.ids == pieces.best_path(r.unit) and r.blocks == [1]


def test_decode_column(llm, pieces):
    rows = llm.createDataFrame([(pieces.best_path("▁hello▁world"),), ([],), (None,)], "ids array<int>")
    assert [r[0] for r in rows.select(sentence_piece.decode(rows)).collect()] == ["hello world", "", None]


def test_encode_empty(frame):
    assert sentence_piece.encode(frame([])).count() == 0


# ------------------------------------------------------------------- op 4

def test_url_parts_and_rules(llm):
    urls = [(1, "http://A.Example.NET/en/x?q#f"), (2, "https://example.net/en"), (3, "x://sub.example.com/de/1"),
            (4, "http://b.org/fr/"), (5, "http://b.org/FR/"), (6, "http://net"), (7, None), (8, "no-scheme.net/"),
            (9, "http://badexample.net/en/"), (10, "a://b://c/d"), (11, ""), (12, "http://x.org?/fr/"), (12, "http://x.org?/fr/")]
    pages = llm.createDataFrame([(i, u, None, "r", "h") for i, u in urls], "page_id long, url string, html string, rule string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rank.judge(pages).collect()}
    assert got == {
        1: ("a.example.net", "/en/x", "example.net/en/", "allow"), 2: ("example.net", "/en", "net/", "block"),
        3: ("sub.example.com", "/de/1", "example.com/de/", "block"), 4: ("b.org", "/fr/", "org/fr/", "allow"),
        5: ("b.org", "/FR/", None, "allow"), 6: ("net", "", None, "allow"), 7: ("", "", None, "allow"),
        8: ("", "", None, "allow"), 9: ("badexample.net", "/en/", "net/", "block"), 10: ("b:", "//c/d", None, "allow"),
        11: ("", "", None, "allow"), 12: ("x.org", "", None, "allow")}
    assert url_rank.judge(pages).count() == 13
    assert url_rank.judge(pages.limit(0)).count() == 0


def test_scores_match_power_iteration(llm):
    rng = random.Random(6)
    hosts = [f"h{i}" for i in range(12)]
    links = {(a, b): rng.randrange(1, 4) for a in hosts for b in hosts if a != b and rng.random() < 0.25}
    seeds = [("trust", "h0", 1.0), ("trust", "h3", 0.4), ("distrust", "h5", 1.0), ("distrust", "h7", 0.2)]
    got = {(r.kind, r.host): r.score for r in url_rank.propagate(
        llm.createDataFrame([(a, b, n) for (a, b), n in links.items()], "source string, target string, links long"),
        llm.createDataFrame(seeds, "kind string, host string, seed double")).collect()}
    for kind, turned in (("trust", False), ("distrust", True)):
        m = np.zeros((12, 12))
        for (a, b), n in links.items():
            i, j = int(a[1:]), int(b[1:])
            m[(i, j) if not turned else (j, i)] = n
        m = m / np.maximum(1, m.sum(axis=1, keepdims=True))
        own = np.zeros(12)
        for k, h, s in seeds:
            if k == kind:
                own[int(h[1:])] = s
        want = np.linalg.solve(np.eye(12) - url_rank.DAMPING * m.T, (1 - url_rank.DAMPING) * own)
        for i, h in enumerate(hosts):
            assert got.get((kind, h), 0.0) == pytest.approx(want[i], abs=2e-3)


def test_links_spread_trust_and_distrust(llm):
    pages = llm.createDataFrame([
        (1, "http://bad.net/x", "<a href='/y'>"), (2, "http://farm.com/a", "<A HREF=\"http://Bad.net/\">x</a>"),
        (3, "http://good.org/fr/", "<a href=//friend.com/z>"), (4, "http://friend.com/a", ""), (5, "http://other.com/", None)],
        "page_id long, url string, html string")
    got = {r.page_id: r for r in url_rank.judge(pages).collect()}
    assert [got[i].verdict for i in range(1, 6)] == ["block", "block", "allow", "allow", "allow"]
    assert got[2].distrust > 0 and got[4].trust > 0 and got[5].trust == got[5].distrust == 0


def test_op4_covers_all_pages(llm):
    assert url_rank.op4_url_trust(llm, "/root/testdata/sf0.001").count() == table(llm, "/root/testdata/sf0.001", "pages").count()


# ------------------------------------------------------------------- op 5

PAGES = [
    ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Menu</a></nav><article><h1>Head &amp; line</h1>"
     "<p>One  two<br>three&nbsp;<b>bold</b>er<script>var a='</p>';</script></p><p>Last<div class='ad banner'>Buy!</div></article>"
     "<footer>&copy; us</footer></body></html>", "Head & line One two three bolder Last"),
    ("<body><header><h1>Site</h1></header><main><p>Text of it &lt;here&gt; &#228;&#x4e00;</p><aside>Side</aside>"
     "<section id=comments><p>Nice post, really, I liked it a lot.</p></section><form><label>Name</label></form></main>",
     "Text of it <here> ä一"),
    ("<article><ul><li>one<li>two</ul><!-- c --><table><tr><td>a<td>b</table></article><div class='has-sidebar'></div>", "one two a b"),
    ("<div class=cookie-notice>We use cookies on this site, accept them all please</div><p>" + "word " * 30 + "</p><p>Short.</p><p>"
     + "more " * 20 + "</p><ul><li><a href=1>Home</a></li><li><a href=2>About</a></li></ul>", ("word " * 30 + "Short. " + "more " * 20).strip()),
    (None, ""), ("", ""), ("<p", ""), ("<article>a < b &am</article>", "a < b &am"), ("<![if x]><article>kept</article><![endif]>", "kept"),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
    ("<article><p>" + "long " * 200_000 + "</p></article>", ("long " * 200_000).strip()),
]


def test_main_text(llm):
    pages = llm.createDataFrame([(i, None, h, "t", 1) for i, (h, _) in enumerate(PAGES)],
                                "page_id long, url string, html string, text string, words int")
    got = {r.page_id: r for r in html_text.main_text(pages).collect()}
    for i, (_, want) in enumerate(PAGES):
        assert got[i].text == want and got[i].n_chars == len(want), i
    assert html_text.main_text(pages.limit(0)).count() == 0


def op5_text(llm, tmp_path, pages):
    """What op5 makes of each page."""
    llm.createDataFrame([(i, None, h) for i, h in enumerate(pages)], "page_id long, url string, html string").write.parquet(
        f"{tmp_path}/pages.parquet")
    return [r.text for r in sorted(html_text.op5_html_extraction(llm, str(tmp_path)).collect(), key=lambda r: r.page_id)]


def test_op5_reads_on_behind_declarations(llm, tmp_path):
    declarations = ["<![end if]-->", "<![ endif]>", "<![>", "<![foo[x]]>", "<![if !IE>", "<![endif]-->", "<!x>", "<![CDATA[a > b]]>"]
    pages = [f"<article><p>one</p>{d}<p>two</p></article>" for d in declarations]
    assert op5_text(llm, tmp_path, pages) == ["one two"] * len(declarations)
    assert "two" in " ".join(b[0] for b in html_text.blocks("<p>one</p><p>two</p><![end if"))


def test_op5_reads_pages_without_end_of_head(llm, tmp_path):
    body = "<article><h1>Head line</h1><p>Text <b>of</b> it</p></article>"
    heads = ["<html><head><title>T</title><meta charset=x><style>p{}</style><body>", "<head><title>T</title><script>x</script>",
             "<head><title>T<body>", "<title>T", "<head>", "<head><title>Use <b>bold</b> <p></title></head><body>",
             "<head><noscript><link href=x></noscript><link href=y>", "<head><title>T</title></head><body>"]
    pages = [h + body for h in heads]
    assert op5_text(llm, tmp_path, pages) == ["Head line Text of it"] * len(pages)
    assert html_text.blocks("<head><title>T</title> bare text")[0][0] == "bare text"


def test_op5_keeps_text_below_words_in_class_and_id(llm, tmp_path):
    long, more = " ".join(f"l{i}" for i in range(60)), " ".join(f"m{i}" for i in range(80))
    article = f"<h2 id='legal-status'>Legal status</h2><p>{long}</p><p>{more}</p>"
    want = f"Legal status {long} {more}"
    menu = "<ul class='nav-list'><li><a href=1>Home</a></li><li><a href=2>About us</a></li></ul>"
    wrapped = [f"<section id='related-work'>{article}</section>", f"<div id='search-algorithms'>{article}</div>",
               f"<div class='header-fixed nav-closed'>{menu}{article}</div>", f"<div class='header-fixed'><article>{article}</article></div>"]
    pages = [f"<article>{w}</article>" if i < 2 else w for i, w in enumerate(wrapped)]
    assert op5_text(llm, tmp_path, [*pages, f"<div class='sidebar'>{article}</div>"]) == [want] * len(pages) + [""]


def test_the_tree_fits_its_table(llm):
    model = html_text.train_tree(llm)
    rows = llm.createDataFrame([tuple(map(float, r)) for r in html_text.LABELLED], [*html_text.FEATURES, "label"])
    from pyspark.sql import functions as F
    said = rows.select(html_text.tree_column(model, F.struct(*html_text.FEATURES)).cast("int").alias("p"), "label")
    assert said.where("p <> label").count() == 0


# ------------------------------------------------------------------- op 6

@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab É1.\n-漢", max_size=20), min_size=1, max_size=5))
def test_trigrams(texts):
    grams, first = language_id.trigrams(texts)
    for i, t in enumerate(texts):
        s = " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
        want = [s[k:k + 3] for k in range(len(s) - 2)] if s.strip() else []
        own = ["".join(" " if (int(g) >> b & 0x1FFFFF) == 1 else chr(int(g) >> b & 0x1FFFFF) for b in (42, 21, 0))
               for g in grams[first[i]:first[i + 1]]]
        assert own == want


def test_filter_returns_every_language(llm):
    rows = [("the cat sat on the mat", "en"), ("der hund und die katze", "de"), ("hund cat", None), (None, "en")]
    model = language_id.train(llm.createDataFrame(rows * 3, "text string, lang string"))
    assert model.languages == ["de", "en"]
    grams, _ = language_id.trigrams(["the", "hund", " d"])
    masks = model.masks(grams)[:, 0]
    assert set(masks[:3].tolist()) == {2} and set(masks[3:7].tolist()) == {1}
    assert model.predict([None, "", "123 !", "the cat", "die hunde"])[0] == ["und", "und", "und", "en", "de"]
    none = language_id.train(llm.createDataFrame([], "text string, lang string"))
    assert none.predict(["abc"]) == (["und"], [0.0])


def test_held_out_accuracy(llm):
    docs = table(llm, "/root/testdata/sf0.01", "documents")
    got = language_id.op6_language_id(llm, "/root/testdata/sf0.01").join(docs, "doc_id").select(
        "doc_id", "held_out", "lang_pred", "lang", "score").collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    kept_back = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in kept_back) / len(kept_back) > 0.97


def test_language_of_odd_rows(frame):
    docs = frame([(1, "some words of text"), (None, "some words"), (3, None), (4, "..."), (1, "some words of text")])
    got = sorted((r.doc_id or 0, r.lang_pred, r.held_out) for r in language_id.language_id(docs).collect())
    assert [g[:2] for g in got] == [(0, "en"), (1, "en"), (1, "en"), (3, "und"), (4, "und")]
    assert not got[0][2]
    assert language_id.language_id(frame([])).count() == 0
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1]


# ------------------------------------------------------------------- op 8

@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2 ** 32 - 1)), max_size=900), max_size=5))
def test_segments_come_back(docs):
    flat = np.array([x for d in docs for x in d], dtype=np.int64)
    ids, lengths = token_files.read_segment(token_files.write_segment(flat, np.array([len(d) for d in docs], dtype=np.int64)))
    assert ids.tolist() == flat.tolist() and lengths.tolist() == [len(d) for d in docs]


def test_the_index_opens_one_block():
    rng = np.random.default_rng(1)
    flat = rng.integers(0, 50_000, 5000)
    raw = np.frombuffer(token_files.write_segment(flat, np.array([5000])), np.uint8)
    index = raw[16:16 + 40].view("<u4").astype(np.int64)
    assert token_files.read_blocks(raw, index[3:4]).tolist() == flat[3 * 512:4 * 512].tolist()
    with pytest.raises(ValueError):
        token_files.read_segment(b"\0" * 32)


def test_encoder_is_the_library():
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(token_files.default_tokenizer())
    whole.encode_special_tokens = True
    own = token_files.Encoder(token_files.default_tokenizer())
    rng = random.Random(3)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices(" \n\t  ab's1.,é漢\u00a0\u2003", k=rng.randrange(14))) for _ in range(3000)]
    for text, raw in zip(texts, own.encode(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_encoder_asks_the_model_for_words_of_letters():
    own = token_files.Encoder(token_files.default_tokenizer(), added=True)
    asked, batch = [], own._batch
    own._batch = lambda parts: asked.extend(parts) or batch(parts)
    own.encode(["First word, wörd слово λόγος\nLine of letters.", "First x1 word"])
    assert sorted(asked) == [" x1", ",", ".", "First"]

    class Known(dict):
        def __iter__(self):
            raise AssertionError("all known words are gone through")
    own.words = Known(own.words)
    own.encode(["First word and another"])


def test_encoder_on_every_letter_and_odd_batch(monkeypatch):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(token_files.default_tokenizer())
    texts = [f"{x}{x} b{x} {x}c,\n{x}d {x}{x}.{x}\n\n{x}" for x in map(chr, [*range(0x620), 0x1C5, 0x10D0, 0x4E00, 0x1F600])]
    texts = [None, "", *texts, "a <|endoftext|> b", " a", "a  b", "a\t b", "\n", "\nA b\n", "\r\nA b", None]
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    for remembered in (token_files.REMEMBERED, 40):
        monkeypatch.setattr(token_files, "REMEMBERED", remembered)
        own = token_files.Encoder(token_files.default_tokenizer(), added=True)
        for _ in range(2):
            got = []
            for a in range(0, len(texts), 50):
                ids, lengths = own.encode_array(pa.array(texts).slice(a, 50))
                ends = np.cumsum(lengths)
                got += [ids[e - n:e].tolist() for e, n in zip(ends, lengths)]
            assert got == want
    assert [x.tolist() for x in own.encode_array(pa.array([None, ""], pa.string()))] == [[], [0, 0]]
    assert [x.tolist() for x in own.encode_array(pa.array([], pa.string()))] == [[], []]


def test_segments_hold_whole_documents(monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 7)
    texts = ["a b c", None, "d " * 40 + "e", "f", "g h i j k l", "m"]
    batches = [pa.RecordBatch.from_pydict({"part": pa.array([3] * (b - a), pa.int32()), "doc_id": pa.array(range(a, b), pa.int64()),
                                           "text": pa.array(texts[a:b], pa.string())}) for a, b in ((0, 4), (4, 4), (4, 6))]
    rows = [r for out in token_files._segments(token_files.default_tokenizer(), False)(iter(batches)) for r in out.to_pylist()]
    assert [r["doc_ids"] for r in rows] == [[0, 1, 2], [3, 4], [5]]
    assert [(r["part"], r["segment"]) for r in rows] == [(3, 0), (3, 1), (3, 2)]
    before = 0
    own = token_files.Encoder(token_files.default_tokenizer())
    for r in rows:
        ids, lengths = token_files.read_segment(r["payload"])
        want = [np.frombuffer(x, "<u4").tolist() + [0] for x in own.encode([texts[d] or "" for d in r["doc_ids"]])]
        assert ids.tolist() == [i for w in want for i in w] and lengths.tolist() == list(map(len, want))
        assert r["before"] == before and r["n_ids"] == len(ids)
        before += len(ids)


def test_token_files(frame, llm, tmp, monkeypatch):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(token_files.default_tokenizer())
    whole.encode_special_tokens = True
    rows = [(1000 - i, t) for i, t in enumerate(TEXTS * 3)] + [(5, "same"), (5, "same"), (None, "null id")]
    random.Random(1).shuffle(rows)
    token_files.write_ids(frame(rows), tmp + "/ids")
    got = sorted(token_files.read_ids(llm, tmp + "/ids").collect(), key=lambda r: r.start)
    start, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    token_files.write_ids(frame([]), tmp + "/none")
    assert token_files.read_ids(llm, tmp + "/none").count() == 0


def test_op8_gives_added_tokens_their_ids(llm, tmp_path):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(token_files.default_tokenizer())
    texts = ["plain text", "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>\n<|endoftext|> y <|endoftext", None, "behind all"]
    assert 50256 in whole.encode(texts[1], add_special_tokens=False).ids
    llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(token_files.op8_token_files(llm, str(tmp_path)).collect(), key=lambda r: r.start)
    start = 0
    for i, t in enumerate(texts):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


# ------------------------------------------------------------------- op 9

def brute_nearest(rows, every, k):
    valid = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for i, q in valid:
        if i % every == 0:
            found = sorted((-float(one_bit_search._inner(v[None, :], q)[0]), j) for j, v in valid if j != i and len(v) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out)


def test_nearest_matches_brute_force(llm, monkeypatch):
    monkeypatch.setattr(one_bit_search, "ROWS_BLOCK", 100)
    monkeypatch.setattr(one_bit_search, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(9)
    rows = [(i, (rng.standard_normal(24) * rng.choice([0.01, 1, 50])).tolist()) for i in range(400)]
    rows += [(400 + i, rows[i][1]) for i in range(20)]
    rows += [(500, None), (520, []), (540, [0.0] * 24), (560, [1.0, None] + [0.0] * 22), (580, [float("nan")] * 24),
             (600, [float("inf")] + [1.0] * 23), (None, [1.0] * 24), (620, [3.0, 4.0]), (640, [1e-200] * 24)]
    vectors = llm.createDataFrame([(i, v, 1, "u") for i, v in rows], "vec_id long, embedding array<double>, rank int, uid string")
    got = sorted(map(tuple, one_bit_search.nearest(vectors, 20, 7).collect()))
    assert got == brute_nearest(rows, 20, 7)
    few = llm.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (0, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in one_bit_search.nearest(few, 20).collect()] == [(0, 1, 1, 4.0)]
    assert one_bit_search.nearest(vectors.limit(0), 20).count() == 0


def test_recall_on_embeddings(llm):
    rows = [(r.vec_id, r.embedding) for r in table(llm, "/root/testdata/sf0.01", "embeddings").collect()]
    got = {(r.query_id, r.vec_id) for r in one_bit_search.op9_one_bit_neighbours(llm, "/root/testdata/sf0.01").collect()}
    want = {(r[0], r[2]) for r in brute_nearest(rows, 20, 20)}
    assert len(got & want) / len(want) >= 0.99


# ------------------------------------------------------------------- pipeline

def test_pipeline_matches_brute_force(llm, tmp, pieces):
    rng = random.Random(12)
    source = table(llm, "/root/testdata/sf0.001", "documents")
    first = source.collect()
    extra = [(9000, None), (9001, "12345 !!"), (9002, first[0].text), (9003, first[1].text + " more")]
    block = "".join(rng.choices("abcdefg hij klm", k=450))
    extra += [(9004, "Start. " + block), (9005, block + " Another end.")]
    docs = source.unionByName(llm.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in extra], source.schema))
    docs.write.parquet(tmp + "/documents.parquet")
    bench = table(llm, "/root/testdata/sf0.001", "benchmark")
    bench.write.parquet(tmp + "/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(llm, tmp).collect()}

    rows = [(r.doc_id, r.text) for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)]
    groups = brute.classes(rows)
    rows = [(i, t) for i, t in rows if groups[i][0] == i]
    cut = brute.cut_repeats([t.encode() for _, t in rows], suffix_dedup.PASSAGE)
    rows = [(i, c[4].decode("utf-8", "ignore")) for (i, _), c in zip(rows, cut)]
    found = {d for d, _, _ in brute.contained(rows, [(r.item_id, r.text) for r in bench.collect()])}
    rows = [(i, t) for i, t in rows if i not in found]
    assert set(got) == {i for i, _ in rows}
    for i, t in rows:
        assert got[i].ids == [x for w in pieces.words(t) for x in pieces.best_path(w)]
        assert got[i].round_trip and got[i].n_tokens == len(got[i].ids)


def test_stages_survive_empty_documents(llm):
    docs = table(llm, "/root/testdata/sf0.001", "documents").limit(0)
    for name, function in corpus_pipeline.STAGES:
        out = function(llm, docs, "/root/testdata/sf0.001")
        assert out.count() == 0
        if name != "sentencepiece":
            assert out.columns == docs.columns


_LONG = ("This is a paragraph of running text about the harbour and its boats, long enough that nothing but its place on the "
         "page tells it from the article: the boats go out before the sun is up, and come back in the afternoon with the tide, "
         "when the market on the quay opens and people come to buy.")


@pytest.mark.parametrize("name", ["id=comments", "class=comment-list", "class=comments-area", "class=comment-body", "class=user-comments",
                                  "id=sidebar", "id=footer", "class=site-footer", "class=cookie-banner", "class=ad-container",
                                  "class=sponsored-box", "class=promo-text"])
def test_named_parts_are_no_main_text_however_long(llm, name):
    page = f"<body><article><h1>Boats</h1><p>{_LONG} Main.</p></article><div {name}><p>{_LONG} Aside.</p></div></body>"
    df = llm.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    text = html_text.main_text(df).first()["text"]
    assert "Main." in text and "Aside." not in text


@pytest.mark.parametrize("name", ["header", "widget", "search"])
def test_a_wrapper_of_the_page_is_not_decisive(llm, name):
    pages = [f"<body><div class='{name}'><article><p>{_LONG} Main.</p></article></div><p>{_LONG}</p></body>",
             f"<body><div class='{name}'><p>{_LONG} Main.</p><p>{_LONG} More.</p></div></body>"]
    df = llm.createDataFrame([(i, "u", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    assert all("Main." in r["text"] for r in html_text.main_text(df).collect())


@pytest.mark.parametrize("unit, end", [("<a href=x ", ""), ("<span>", "</x>"), ("<span>", "<hr>"), ("<p>", ""), ("<div>", "</div>"),
                                       ("<", ""), ("<!--", ""), ("</p", ""), ("<h1><li>", "<tr>")])
def test_malformed_pages_take_time_in_proportion(unit, end):
    import time
    page = unit * (500_000 // len(unit)) + (end * (500_000 // len(end)) if end else "")
    began = time.process_time()
    html_text.blocks(page)
    assert time.process_time() - began < 12
