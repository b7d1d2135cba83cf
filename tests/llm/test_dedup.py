"""Operators 1, 2, 7 and 10 against brute force on small inputs."""

import functools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import decontaminate, jaccard_join, sentence_spans, suffix_dedup
from strata.llm.components import connected_components
from strata.llm.text import code_points, word_ranges
from strata.llm.winnow import Pieces, batches

from . import brute


def prose(rng, n, vocabulary=400):
    out = []
    for i in range(n):
        w = f"w{rng.randrange(vocabulary)}"
        out.append(w.capitalize() if not i or out[-1].endswith(".") else w)
        if rng.random() < 0.12:
            out[-1] += "."
    return " ".join(out)


def near(rng, text, rate):
    return " ".join(f"x{rng.randrange(999)}" if rng.random() < rate else w for w in text.split(" "))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    base = [prose(rng, rng.choice([6, 40, 150, 400])) for _ in range(30)]
    rows = list(enumerate(base))
    for k, rate in enumerate([0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.2] * 5):
        rows.append((100 + k, near(rng, base[k % 11], rate)))
    passage = prose(rng, 70)
    rows += [(200 + k, f"{prose(rng, 30)}\n{passage}\n{prose(rng, 30)}") for k in range(6)]
    rows += [(300, None), (301, ""), (302, "###"), (303, "one two"), (304, "One, two!"), (305, "###")]
    rng.shuffle(rows)
    return rows


# ------------------------------------------------------------------- op 2

def test_banding_reaches_its_recall():
    bands, rows = jaccard_join.choose_banding(0.8, 0.9995, 128)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9995 and bands * rows <= 128


def test_jaccard_join_matches_brute_force(frame, corpus):
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_join(frame(corpus)).collect()}
    assert got == brute.classes(corpus)


def test_jaccard_join_with_small_blocks(frame, corpus, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    rng = random.Random(8)
    base = prose(rng, 200)
    rows = [(i, near(rng, base, 0.008)) for i in range(40)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_join(frame(rows)).collect()}
    assert got == brute.classes(rows)


def test_jaccard_join_null_ids_and_repeated_rows(frame):
    text = "a b c d e f g h i j"
    rows = [(None, text), (7, text), (7, text), (5, text + " k"), (None, "q r s t u v"), (None, "l m n o p q")]
    found = jaccard_join.jaccard_join(frame(rows)).collect()
    got = sorted((r.doc_id or -1, r.class_id or -1, r.n_copies, r.n_links) for r in found)
    assert got == [(-1, -1, 1, 0), (-1, -1, 1, 0), (-1, 5, 3, 3), (5, 5, 1, 3), (7, 5, 3, 3), (7, 5, 3, 3)]


def test_keep_one(frame, corpus):
    want = sorted(i for i, (c, _) in brute.classes(corpus).items() if i == c)
    kept = jaccard_join.keep_one(frame(corpus))
    assert kept.columns == frame(corpus).columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == want
    again = frame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "###"), (None, "###"),
                   (None, "g h i j k l"), (None, "g h i j k l")])
    assert sorted((r.doc_id or 0, r.text) for r in jaccard_join.keep_one(again).select("doc_id", "text").collect()) == [
        (0, "###"), (0, "###"), (0, "g h i j k l"), (1, "a b c d e f")]


def test_components(llm):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 200), (7, 7)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in connected_components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200}
    assert connected_components(llm.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------- op 7

def test_pieces_cover_every_window_once(monkeypatch):
    rng = random.Random(5)
    texts = [bytes(rng.choices(b"abcd", k=n)) for n in (0, 9, 10, 11, 300, 77)]
    for segment in (1 << 22, 64):
        monkeypatch.setattr("strata.llm.winnow.SEGMENT", segment)
        seen = []
        for parts in batches(texts, 10):
            p = Pieces(parts, 10, 6)
            for t, o, w in zip(p.text, p.offset, p.windows):
                seen += [(int(t), int(o) + k) for k in range(w)]
        assert sorted(seen) == [(i, k) for i, t in enumerate(texts) for k in range(len(t) - 9)]


def byte_rows():
    rng = random.Random(11)
    rows = []
    shared = ["".join(rng.choices("abé c.", k=rng.randrange(10, 90))) for _ in range(12)]
    for i in range(60):
        rows.append((i, "".join(rng.choice(shared) if rng.random() < 0.4 else "".join(rng.choices("xyzéàb ", k=rng.randrange(30)))
                                for _ in range(rng.randrange(1, 6)))))
    rows += [(90, "m" * 200), (91, "n" * 19), (92, None), (93, ""), (94, rows[0][1]), (95, "ab" * 300)]
    return rows


@pytest.mark.parametrize("most", [1024, 1])
def test_suffix_dedup_matches_brute_force(frame, most):
    rows = byte_rows()
    out = suffix_dedup.remove_repeats(frame(rows), 20, gram=15, most=most).select("doc_id", "_strata_cut.*").collect()
    want = dict(zip((i for i, _ in rows), brute.cut_repeats([(t or "").encode() for _, t in rows], 20)))
    assert {r.doc_id: (r.n_removed, r.n_spans, bytes(r.kept)) for r in out} == {
        i: (w[1], w[2], w[4]) for i, w in want.items()}


def test_op7_on_documents(llm):
    got = suffix_dedup.op7_suffix_array_dedup(llm, "/root/testdata/sf0.001").collect()
    rows = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip((r.doc_id for r in rows), brute.cut_repeats([(r.text or "").encode() for r in rows], 400)))
    assert {r.doc_id: tuple(r)[1:] for r in got} == {i: w[:4] for i, w in want.items()}


def test_without_repeats_keeps_rows_and_columns(frame):
    block = "é" * 150 + "".join(chr(97 + i % 23) for i in range(301))
    docs = frame([(1, "start " + block), (2, block + " end"), (3, "alone"), (4, None)])
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: ("start ", 6), 2: (" end", 4), 3: ("alone", 5), 4: (None, None)}


# ------------------------------------------------------------------- op 1

def test_sentence_spans_match_brute_force(frame, corpus):
    rows = sorted(corpus, key=lambda r: r[0])
    got = {r.doc_id: r.text for r in sentence_spans.remove_later_spans(frame(corpus)).collect()}
    want = brute.cut_spans(rows)
    assert got == want and sum(len(t or "") for t in got.values()) < sum(len(t or "") for _, t in rows)


def test_sentence_spans_within_a_text_null_ids_and_repeats(frame):
    span = "Some first sentence with a few words. And then a second one that goes on. "
    rows = [(None, span), (2, span + "Other words stand here in between, enough of them. Yes. " + span + "End."), (3, "Unrelated."),
            (4, span), (4, span)]
    got = sorted(((r.doc_id or 99, r.text, r.n_spans) for r in sentence_spans.remove_later_spans(frame(rows)).collect()))
    assert got == [(2, span + "Other words stand here in between, enough of them. Yes. End.", 1), (3, "Unrelated.", 0),
                   (4, "", 1), (4, "", 1), (99, "", 1)]


def test_a_long_sentence_repeats(frame):
    rng = random.Random(2)
    passage = " ".join(f"v{rng.randrange(10_000)}" for _ in range(60)) + "."
    rows = [(i, f"{prose(rng, 20)}.\n{passage}\n{prose(rng, 20)}") for i in range(3)]
    got = {r.doc_id: r.text for r in sentence_spans.remove_later_spans(frame(rows)).collect()}
    assert got == brute.cut_spans(rows)
    assert passage.split()[10] in got[0] and passage.split()[10] not in got[1]


def on_documents(llm, tmp_path, rows, query):
    """What a query makes of (doc_id, text) rows: doc_id -> text."""
    llm.createDataFrame(rows, "doc_id long, text string").coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    return {r.doc_id: r.text for r in query(llm, str(tmp_path)).collect()}


def repeated_windows(rows, left, n=50):
    """Windows of n words left in a text that stand in an earlier one."""
    seen, out = set(), []
    for d, text in rows:
        w, kept = brute.words(text), brute.words(left[d])
        out += [k for i in range(len(kept) - n + 1) if (k := tuple(kept[i:i + n])) in seen]
        seen |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
    return out


def test_op1_cuts_passages_of_short_sentences(llm, tmp_path):
    rng = random.Random(5)

    def passage(end, size):
        return "".join(f"p{rng.randrange(10_000)}" + (end if i % size == size - 1 else " ") for i in range(60))
    passages = [passage("\n", 5), passage("! ", 3), passage("!! ", 1), passage(". ", 4)]
    rows = [(10 * k + i, f"{prose(rng, 20)}.\n{p}\n{prose(rng, 20)}") for k, p in enumerate(passages) for i in range(3)]
    left = on_documents(llm, tmp_path, rows, sentence_spans.op1_substring_dedup)
    assert not repeated_windows(rows, left) and repeated_windows(rows, dict(rows))
    for k, p in enumerate(passages):
        assert left[10 * k] == rows[3 * k][1] and not {*brute.words(p)[20:40]} & {*brute.words(left[10 * k + 1])}


def test_op1_cuts_passages_whatever_their_sentences(llm, tmp_path):
    rng = random.Random(6)

    def words(n):
        return [f"p{rng.randrange(10_000)}" for _ in range(n)]
    running = [" ".join(words(n)) for n in (50, 64, 300)]
    passages = [(p, p) for p in running]
    marked = words(60)
    passages.append((" ".join(f"{w}.***" if i % 8 == 7 else w for i, w in enumerate(marked)), " ".join(marked)))
    quoted = words(60)
    passages.append((" ".join(f'{w}."' if i % 7 == 6 else w for i, w in enumerate(quoted)),) * 2)
    rows = []
    for k, (one, two) in enumerate(passages):
        rows += [(10 * k + i, f"{' '.join(words(3 + 7 * i))} {p} {' '.join(words(30))}") for i, p in enumerate([one, two, one])]
    left = on_documents(llm, tmp_path, rows, sentence_spans.op1_substring_dedup)
    assert not repeated_windows(rows, left) and all(left[10 * k] == rows[3 * k][1] for k in range(len(passages)))


def test_sentences_of_other_scripts_and_closing_marks():
    def cut(text):
        first = sentence_spans.passages([text], run=1, words=1, long=1000)["begin"].tolist()
        return [text[a:b].strip() for a, b in zip(first, [*first[1:], len(text)])]
    assert cut("यह। वह") == ["यह।", "वह"] and cut("یہ ہے۔ وہ کیا؟ ہاں") == ["یہ ہے۔", "وہ کیا؟", "ہاں"]
    assert cut("他来了。我走了！好吗？") == ["他来了。", "我走了！", "好吗？"]
    assert cut('He said." Then 3.5 was.*** x') == ['He said."', "Then 3.5 was.***", "x"]
    chinese = "他来了我走了今天天气很好我们一起去公园散步然后回家吃饭看书睡觉明天再见朋友们都很高兴见到你们来这里玩了一整天"
    a, b = (sentence_spans.passages([t])["a"].tolist() for t in (chinese, "x" + chinese))
    assert set(a) & set(b)


@functools.cache
def rank(word):
    """The order of words by which op 1 chooses the places of its long spans."""
    return int(word_ranges(code_points(word), unspaced=True)[2][0]) >> 32


def test_op1_matches_brute_force(llm, tmp_path, corpus):
    rng = random.Random(21)
    lines = ["\n".join(f"{prose(rng, rng.randrange(1, 6))}{rng.choice(['.', '?!', '.\"', '', '...'])}" for _ in range(30)) for _ in range(6)]
    rows = [*corpus, *((1000 + i, prose(rng, 40) + " " + rng.choice(lines) + " " + rng.choice(lines)) for i in range(25))]
    rows += [(2000, "一二三四五六七。" * 9), (2001, "前 " + "一二三四五六七。" * 5 + "後"), (2002, None), (2003, ""), (2004, " .!? \n"),
             (2005, "a " * 80), (2006, lines[0])]
    rows = sorted({d: (d, t) for d, t in rows if d is not None}.values())
    got = on_documents(llm, tmp_path, rows, sentence_spans.op1_substring_dedup)
    assert got == brute.cut_passages(rows, rank)
    assert sum(len(t or "") for t in got.values()) < sum(len(t or "") for _, t in rows)


def test_op1_on_documents(llm):
    sf = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text) for r in llm.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r.text for r in sentence_spans.op1_substring_dedup(llm, sf).collect()}
    assert got == brute.cut_passages(rows, rank)


# ------------------------------------------------------------------- op 10

def test_layouts_reach_their_recall():
    for size in range(12):
        step, bands, rows = decontaminate.layout(size)
        most = 1 << size
        least = most // 2 + 1 if size else 1
        jaccard = 0.8 * least / (3 * step + 0.2 * least)
        assert 3 * step >= most + step - 1 and 1 - (1 - jaccard ** rows) ** bands >= 0.9995


def test_decontamination_matches_brute_force(llm, frame):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.choice([3, 5, 9, 20, 45, 130]), 3000)) for i in range(40)]
    items += [(50, None), (51, ""), (52, "!!"), (53, items[0][1])]
    rows = []
    for k in range(40):
        item = items[k][1]
        if k % 4 == 1:
            item = near(rng, item, 0.02)
        rows.append((k, prose(rng, rng.randrange(0, 1500), 3000) + " " + item + " " + prose(rng, rng.randrange(0, 1500), 3000)))
    rows += [(90, None), (91, ""), (92, items[5][1]), (93, prose(rng, 6000, 3000)), (94, rows[3][1])]
    docs = frame(rows)
    bench = llm.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, uid string, doc_id string")
    got = {(r.doc_id, r.item_id, r.n_shared) for r in decontaminate.find_items(docs, bench).collect()}
    assert got == brute.contained(rows, items)
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({i for i, _ in rows} - {d for d, _, _ in got})


def test_short_items_are_found_inside_long_texts(llm, frame, tmp_path):
    rng = random.Random(9)
    items = [(1, "Quick brown FOX"), (2, "zebra"), (3, "one two three four"), (4, "one two"), (5, "one two three four five"), (6, "fox quick"),
             (7, None), (8, "..."), (9, "Quick brown fox")]
    rows = [(i, prose(rng, 300)) for i in range(20)]
    rows += [(20, prose(rng, 300) + " the quick, brown fox jumps " + prose(rng, 300)), (21, "zebra"), (22, "zebra " * 500),
             (23, "one two three"), (24, prose(rng, 2_000) + " one two three four five"), (25, "quick brown foxes"), (26, None), (27, "")]
    rows += [(28, rows[20][1]), (20, "one two")]
    bench = llm.createDataFrame(items, "item_id long, text string")

    def holds(text, item):
        w, v = brute.words(text), brute.words(item)
        return 0 < len(v) < 5 and any(w[i:i + len(v)] == v for i in range(len(w)))
    docs = frame(rows)
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.find_items(docs, bench, inside=True).where("n_item = 1").collect()
                 if r.item_id != 5)
    assert got == sorted((d, i) for d, t in rows for i, it in items if holds(t, it))
    assert {r.doc_id for r in decontaminate.find_items(docs, bench, inside=True).where("item_id = 5").collect()} == {24}
    # the filter keeps long documents that hold a short phrase
    gone = {i for i, _ in rows} - {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()}
    assert gone == {21, 24}
    # the query's SQL says the same
    docs.select("doc_id", "text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    bench.coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    want = con.execute(decontaminate.ORACLE_OP10).fetchall()
    found = decontaminate.op10_benchmark_decontamination(llm, str(tmp_path)).select(
        "doc_id", "item_id", "n_shared", "n_item", "containment").collect()
    assert sorted(map(tuple, found)) == sorted(want)


def test_the_search_finds_every_item_of_the_benchmark(llm):
    """Recall over all pairs that a full comparison finds."""
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    want = {r[:2] for r in con.execute(decontaminate.ORACLE_OP10).fetchall()}
    got = {(r.doc_id, r.item_id) for r in decontaminate.op10_benchmark_decontamination(llm, sf).collect()}
    assert want and got == want


# ------------------------------------------------------------------- empty tables

def test_empty_tables(llm, frame):
    none = frame([])
    bench = llm.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert jaccard_join.jaccard_join(none).count() == 0
    assert jaccard_join.keep_one(none).count() == 0
    assert suffix_dedup.without_repeats(none).count() == 0
    assert sentence_spans.remove_later_spans(none).count() == 0
    assert decontaminate.find_items(none, bench).count() == 0
    assert decontaminate.find_items(frame([(1, "a b c d e f")]), bench.limit(0)).count() == 0
    nulls = frame([(None, None), (None, None)])
    assert jaccard_join.jaccard_join(nulls).select(F.sum("n_links")).first()[0] == 0
    assert jaccard_join.keep_one(nulls).count() == 2
    assert suffix_dedup.without_repeats(nulls).count() == 2
    assert sentence_spans.remove_later_spans(nulls).count() == 2
    assert decontaminate.drop_contaminated(nulls, bench).count() == 2
