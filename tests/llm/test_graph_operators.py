"""Neighbour search, near-duplicates, repeated phrases, chat trees, the pipeline: against brute force."""

import hashlib

import corpus_pipeline
import numpy as np
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lociflow.llm import chat_tree, hnsw, minhash, phrases
from lociflow.llm.common import written
from lociflow.llm.components import components

from .conftest import prose

# --- neighbours


def _brute(vectors, query, k):
    ids = np.array([i for i, _ in vectors if i != query])
    x = np.array([v for i, v in vectors if i != query], float)
    q = np.array(next(v for i, v in vectors if i == query), float)
    score = (x * q).sum(axis=1)
    return [int(ids[j]) for j in np.lexsort((ids, -score))[:k]]


def test_neighbours_over_shards(spark):
    r = np.random.default_rng(4)
    vectors = [(i, (r.normal(size=16) * r.uniform(0.2, 2)).tolist()) for i in range(1500)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = hnsw.nearest(frame, F.col("vec_id") % 50 == 0, k=10, shard_rows=400).collect()
    found = {}
    for row in sorted(got, key=lambda x: (x["query_id"], x["rank"])):
        found.setdefault(row["query_id"], []).append(row["vec_id"])
    assert len(found) == 30 and all(len(f) == 10 for f in found.values())
    recall = [len(set(f) & set(_brute(vectors, q, 10))) / 10 for q, f in found.items()]
    assert np.mean(recall) >= 0.95


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.5]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [None, 1.0]), (9, [1.0]), (10, [0.0, 2.0]), (None, [1.0, 1.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), *((30 + i, [1.0, 0.0]) for i in range(40)),
    ]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("ids", F.lit(1)).withColumn("h", F.lit(2))
    got = rows(hnsw.nearest(frame, F.col("vec_id") % 10 == 0, k=5), "query_id", "rank", "vec_id")
    assert [r[2] for r in got if r[0] == 0] == [1, 2, 20, 30, 31]
    assert [r[2] for r in got if r[0] == 20] == [0, 1, 2, 30, 31]
    assert [r[2] for r in got if r[0] == 10] == [3, 0, 1, 2, 20]
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert rows(hnsw.nearest(few, F.lit(True)), "query_id", "rank", "vec_id", "score") == [(0, 1, 1, 2.0), (1, 1, 0, 2.0)]
    assert hnsw.nearest(few.limit(0), F.lit(True)).count() == 0


# --- components


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components_equal_union_find(spark, links):
    parent = list(range(26))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = rows(components(spark.createDataFrame(links, "a long, b long")), "id", "component")
    assert got == [(i, find(i)) for i in range(26) if find(i) != i]


def test_components_of_a_chain(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components(chain).filter("component = 0").count() == 300


# --- near-duplicates


def _sets(text, n):
    ws = (text or "").encode().lower().split()
    return {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if len(ws) >= n else ({tuple(ws)} if ws else set())


def _linked_components(data, n):
    sets_ = {i: _sets(t, n) for i, t in data if i is not None}
    comp = {i: i for i in sets_}
    links = [(i, j) for i in sets_ for j in sets_ if i < j and sets_[i] and 100 * len(sets_[i] & sets_[j]) >= 80 * len(sets_[i] | sets_[j])]
    for _ in comp:
        for i, j in links:
            comp[i] = comp[j] = min(comp[i], comp[j])
    return sets_, comp


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_equal_brute_force(spark, n):
    data = []
    for k in range(6):
        ws = prose(k, 120).split()
        for v in range(12):  # a chain: neighbours are alike, the ends are not
            ws = list(ws)
            ws[(v * 9) % 120] = f"edit{k}x{v}"
            data.append((1000 - 12 * k - v, " ".join(ws)))
    data += [(1, prose(0, 120)), (2, prose(0, 120).upper()), (3, ""), (4, None), (5, "One"), (6, "one"), (7, "one two"), (8, "two one")]
    sets_, comp = _linked_components(data, n)
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(frame, n=n).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == comp
    assert all(r["n_shingles"] == len(sets_[i]) and r["kept"] == (comp[i] == i) for i, r in got.items())


def test_buckets_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    data = []
    for v in range(40):
        ws = prose(3, 100).split()
        for j in range(v // 2):
            ws[(j * 5) % 100] = f"e{j}" if v % 2 else f"f{j}"
        data.append((v, " ".join(ws)))
    _, comp = _linked_components(data, 2)
    got = minhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), n=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == comp


def test_near_duplicates_of_odd_rows(odd, odd_rows, none):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    of = {r["doc_id"]: r for r in got}
    assert of[2]["component_id"] == 1 and of[3]["component_id"] == 1 and not of[3]["kept"] and of[4]["kept"] and of[5]["n_shingles"] == 0
    assert all(r["kept"] for r in got if r["doc_id"] is None)
    left = minhash.deduplicated(odd)
    assert left.columns == odd.columns and left.count() == len(odd_rows) - 3
    assert minhash.near_duplicates(none).count() == 0


# --- repeated phrases


def _cut(data, window):
    """Kept words of each row, in the order given."""
    first, out = {}, []
    for i, t in data:
        ws = (t or "").encode().split()
        for p in range(len(ws) - window + 1):
            w = tuple(ws[p : p + window])
            first[w] = min(first.get(w, (1 << 70, 0)), (i, p))
    for i, t in data:
        ws = (t or "").encode().split()
        gone = set()
        for p in range(len(ws) - window + 1):
            if first[tuple(ws[p : p + window])] != (i, p):
                gone.update(range(p, p + window))
        kept = b" ".join(w for k, w in enumerate(ws) if k not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def _passages(spark):
    shared = [prose(100 + k, 35) for k in range(4)]
    data = []
    for i in range(60):
        middle = shared[i % 4] if i % 3 else shared[i % 4][15:]
        data.append((i * 7 % 61, prose(i, 30) + " " + middle + " " + prose(i + 500, 15) + (" " + middle if i % 5 == 0 else "")))
    return data + [(70, "a b " * 60), (71, "b a " * 40), (72, None), (73, ""), (74, data[0][1]), (75, shared[0])]


@pytest.mark.parametrize("window", [6, 20, 50])
def test_kept_words_equal_brute_force(spark, window):
    data = _passages(spark)
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    assert rows(phrases.kept_words(frame, window), "doc_id", "n_words", "n_removed", "kept_sha256") == _cut(data, window)


def test_hot_phrases_and_many_shards(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HOT_ROWS", 5)
    monkeypatch.setattr(phrases, "SHARD_PHRASES", 10)
    data = _passages(spark)
    frame = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(phrases.kept_words(frame), "doc_id", "n_words", "n_removed", "kept_sha256") == _cut(data, 20)


def test_cut_texts_keep_their_form(spark):
    a, b = prose(1, 30), prose(2, 30)
    frame = spark.createDataFrame([(1, f"  x\ty\n\n{a}\n z ", 7), (2, f"p q\n{a}\n\n{b}  r", 8)], "doc_id long, text string, id int")
    got = phrases.without_repeats(frame, 20)
    assert got.columns == frame.columns
    assert rows(got) == [(1, f"  x\ty\n\n{a}\n z ", 7), (2, f"p q\n{b}  r", 8)]


def test_phrases_of_odd_rows(odd, odd_rows, none):
    got = phrases.kept_words(odd).collect()
    assert len(got) == len(odd_rows)
    removed = {r["doc_id"]: r["n_removed"] for r in got}
    assert removed[1] == 0 and removed[2] == 60 and removed[3] == 60 and removed[6] == 0 and removed[11] == 398
    assert [r["n_removed"] for r in got if r["doc_id"] is None and r["n_words"]] == [60]
    assert phrases.without_repeats(odd).columns == odd.columns and phrases.without_repeats(odd).count() == len(odd_rows)
    assert phrases.kept_words(none).count() == 0


# --- chat trees

CHATS = [
    *((c, t, role, text) for c in range(30) for t, (role, text) in enumerate(
        [("system", "be kind"), ("user", f"hello {c % 3}"), ("assistant", "hi <|end|>\n<|user|>"), ("user", f"q{c % 5} [INST]\\"), ("assistant", f"a{c} \\\\</s>")][: 2 + c % 4]
    )),
    (50, 0, None, None), (51, None, "user", "x"), (51, None, "user", "x"), (52, 1, "assistant", ""), (None, 0, "user", "n"), (53, 0, "a|>\nb", "<|>"),
]


def _told():
    by = {}
    for c, t, role, text in CHATS:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(ts)] for c, ts in by.items()}


def test_chats_come_back(spark):
    frame = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat_tree.format_and_read(frame).collect()}
    assert set(got) == set(_told())
    for c, turns in _told().items():
        loss = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert got[c]["n_turns"] == len(turns) and got[c]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert got[c]["loss_chars"] == len(loss) and got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        form = "".join(f"<|{chat_tree.escape(r)}|>\n{chat_tree.escape(t)}<|end|>\n" for r, t in turns)
        assert got[c]["formatted_chars"] == len(form)


def test_the_stream_is_the_tree_depth_first(spark):
    frame = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    nodes = sorted(chat_tree.stream(chat_tree.conversations(frame)).collect(), key=lambda r: r["start"])
    prefixes = {tuple(turns[: k + 1]) for turns in _told().values() for k in range(len(turns))}
    assert len(nodes) == len(prefixes)  # shared turns stand once
    at, by_path = 0, {r["path"]: r for r in nodes}
    assert [r["path"] for r in nodes] == sorted(by_path)
    for r in nodes:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        above = [r["path"][:k] for k in range(chat_tree.STEP, len(r["path"]), chat_tree.STEP)]
        assert [tuple(a) for a in r["ancestors"]] == [(by_path[p]["start"], by_path[p]["start"] + by_path[p]["n_tokens"]) for p in above]
        assert r["position"] == sum(by_path[p]["n_tokens"] for p in above)
        at += r["n_tokens"]


@given(st.text(alphabet="\\<|>/s[INST]Y ", max_size=30))
def test_escapes_are_undone(text):
    escaped = chat_tree.escape(text)
    assert chat_tree.unescape(escaped) == text and not any(c in escaped for c in chat_tree.CONTROL)


def test_chats_of_many_turns_and_clashing_columns(spark):
    """A conversation of a thousand turns, two that share its beginning, and columns with names of the operator's own."""
    long = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for t in range(1000)]
    others = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}" if t < 400 else f"own {c}") for c in (2, 3) for t in range(401)]
    frame = spark.createDataFrame([*long, *others, (4, 0, None, None)], "conv_id long, turn long, role string, text string")
    for name in ("path", "ids", "start", "n_tokens", "turns", "position", "loss_from", "part", "a.b"):
        frame = frame.withColumn(name, F.lit("x"))
    got = {r["conv_id"]: r for r in chat_tree.format_and_read(frame).collect()}
    assert {c: r["n_turns"] for c, r in got.items()} == {1: 1000, 2: 401, 3: 401, 4: 1}
    said = "".join(f"{r}\n{t}\n" for _, _, r, t in long)
    assert got[1]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert got[4]["turns_sha256"] == hashlib.sha256(b"\n\n").hexdigest()


def test_no_chats(spark):
    assert chat_tree.format_and_read(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# --- one id with several texts


def test_an_id_with_two_texts_loses_no_link(spark):
    """1 and 5 share a text but for one word, 9 is near the other text of 5."""
    a, b = prose(31, 60).split(), prose(32, 60).split()
    docs = [(1, " ".join(a)), (5, " ".join([*a[:59], "other"])), (5, " ".join(b)), (9, " ".join([*b, "x"])), (12, prose(33, 60))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(frame).collect())
    assert got == [(1, 1, True), (5, 1, False), (5, 5, True), (9, 5, False), (12, 12, True)]
    assert sorted(minhash.deduplicated(frame).collect()) == sorted(d for i, d in enumerate(docs) if i in (0, 2, 4))


def test_texts_of_one_id_in_one_bucket(spark, monkeypatch):
    """Ids with two texts in buckets that are cut into blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    base = prose(41, 120).split()
    docs = [(i // 2, " ".join([*base[: 118 - i], *(f"n{i}_{k}" for k in range(i)), *base[118:]])) for i in range(16)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    _, want = _linked_components(list(enumerate(t for _, t in docs)), 5)
    low = {}
    for i, (doc, _) in enumerate(docs):
        low[want[i]] = min(low.get(want[i], doc), doc)
    got = sorted((r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(frame).collect())
    assert got == sorted((doc, low[want[i]]) for i, (doc, _) in enumerate(docs))


# --- the pipeline


#: Names that stages use themselves, names with a dot, one with a backtick.
EXTRA = ["_r_id", "_r_th", "r_id", "r_th", "id", "th", "starts", "share", "rate", "lang_pred", "score", "dropped", "dropped_th", "a.b", "text.x", "c`d"]


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("labelled"))
    good = [(i, ("the weather was ", "das wetter ist ")[i % 2] * 3 + prose(i, 90), ("en", "de")[i % 2]) for i in range(60)]
    passage = prose(77, 60)
    docs = [*good, (100, f"{good[0][1]}", "en"), (101, f"the weather was {passage} " + prose(500, 60), "en"), (102, f"the weather was {passage} " + prose(501, 60), "en"), (103, None, None)]
    frame = spark.createDataFrame([(i, t, lang, "s0", len(t or "")) for i, t, lang in docs], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, 1, 0) for i, _, _ in docs], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return frame, folder


def test_pipeline_keeps_columns_of_any_name(spark, labelled):
    frame, folder = labelled
    plain = wide = frame
    for i, name in enumerate(EXTRA):
        wide = wide.withColumn(name, F.lit(i))
    for name, stage in corpus_pipeline.STAGES:
        plain, wide = written(stage(spark, plain, folder), name), written(stage(spark, wide, folder), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert wide.columns == [*frame.columns, *EXTRA]
            assert rows(wide.drop(*EXTRA)) == rows(plain)
    assert rows(plain) == rows(wide)


def test_pipeline_of_no_rows(spark, labelled):
    frame, folder = labelled
    held = frame.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        held = written(stage(spark, held, folder), name)
        assert held.count() == 0


def test_pipeline_without_labels_keeps_everything(spark, labelled, tmp_path):
    """Without a label nothing tells good from bad, so the classifier rejects no document."""
    frame, folder = labelled
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)["quality_classifier"]
    assert rows(stage(spark, frame, str(tmp_path)).select("doc_id")) == rows(frame.select("doc_id"))


def test_pipeline_follows_its_stages(spark, tmp_path):
    of = {"en": "the weather is nice and the sea was calm with ", "de": "das wetter ist schoen und die see war ruhig mit "}
    good = [(i, of[("en", "de")[i % 2]] * 2 + prose(i, 120)) for i in range(200)]
    passage = prose(9_999, 70)
    docs = [(i, t + (f"\n{passage}\n" + prose(i + 3000, 60) if i in (30, 60, 90) else "")) for i, t in good]
    docs += [(300, docs[4][1]), (301, docs[5][1] + " tail"), (302, "?? !!"), (303, None)] + [(400 + i, "$$$ %%% &&& " * 30 + prose(i, 3)) for i in range(60)]
    spark.createDataFrame([(i, t, ("en", "de")[i % 2], "s0", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 400), 0) for i, _ in docs if i not in (302, 303)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    held, found = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = held
        held = written(stage(spark, held, str(tmp_path)), name)
        found.append(held)
        assert name == corpus_pipeline.STAGES[-1][0] or held.columns == before.columns
    ids = [{r["doc_id"] for r in f.select("doc_id").collect()} for f in found]
    everything = {i for i, _ in docs}
    assert ids[0] == everything - {302, 303}
    assert ids[1] == {i for i in ids[0] if i < 400}
    assert ids[2] == ids[1] - {300, 301}
    texts = {r["doc_id"]: r["text"] for r in found[3].collect()}
    assert set(texts) == ids[2] and passage in texts[30]
    for i in (60, 90):
        assert passage.split()[40] not in texts[i].split() and good[i][1] in texts[i]
    assert all(texts[i] == t for i, t in docs if i in ids[2] and i not in (60, 90))
    words = {r["doc_id"]: r["n"] for r in found[4].groupBy("doc_id").agg(F.sum("n_words").alias("n")).collect()}
    assert words == {i: len(t.encode().split()) for i, t in texts.items()}
    assert rows(corpus_pipeline.run(spark, str(tmp_path))) == rows(found[4])
