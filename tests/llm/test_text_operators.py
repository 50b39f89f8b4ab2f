"""Language, quality, byte BPE, token files, fingerprints, packing: brute force, round trips and odd inputs."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lociflow.llm import boosted, byte_bpe, packing, ppm, range_coder, spotsigs

from .conftest import prose


@pytest.fixture(scope="module")
def reference():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


# --- byte BPE


def test_byte_bpe_equals_the_reference_library(odd, odd_rows, reference):
    want = []
    for doc, text, *_ in odd_rows:
        ids = reference.encode_ordinary(text or "")
        want.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    got = [tuple(r) for r in byte_bpe.round_trip(odd).collect()]
    assert Counter(got) == Counter(want)


def test_byte_bpe_encode_and_decode_frames(odd, odd_rows):
    back = byte_bpe.decode(byte_bpe.encode(odd)).select("bytes").collect()
    assert Counter(bytes(r[0]) for r in back) == Counter((t or "").encode() for _, t, *_ in odd_rows)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=80))
def test_byte_bpe_any_text(reference, text):
    codec = byte_bpe.codec(P.path(byte_bpe.VOCABULARY), P.PATTERN)
    ids = codec.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_byte_bpe_of_no_rows(none):
    assert byte_bpe.round_trip(none).count() == 0


# --- range coder


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 511, 512, 513, 5000, 70_001])
@pytest.mark.parametrize("space", [1, 2, 300, 50_257])
def test_blocks_come_back(n, space):
    ids = np.random.default_rng(n).zipf(1.3, n) % space
    assert (range_coder.decode_block(range_coder.encode_block(ids, space)) == ids).all()


def test_blocks_are_small_where_ids_repeat():
    ids = np.tile(np.random.default_rng(0).integers(0, 50_000, 300), 200)
    assert len(range_coder.encode_block(ids, 50_257)) < len(ids) * 2 / 3


def test_damage_is_noticed():
    frame = bytearray(range_coder.encode_block(np.arange(3000), 50_257))
    frame[60] ^= 1
    with pytest.raises(ValueError):
        range_coder.decode_block(bytes(frame))


def test_token_files(odd, odd_rows):
    told = Tokenizer.from_file(P.path(range_coder.TOKENIZER))
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0))
    extra = [(99, "a <|endoftext|> b")]
    frame = odd.select("doc_id", "text").union(odd.sparkSession.createDataFrame(extra, "doc_id long, text string"))
    got = {}
    for r in range_coder.read_ids(range_coder.write_ids(frame, block_ids=1000)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    starts = sorted((r["start"], r["n_tokens"]) for rs in got.values() for r in rs)
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    for doc, text in [*((r[0], r[1]) for r in order), *extra]:
        ids = np.array([*told.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (len(ids), zlib.crc32(ids.tobytes())) in [(r["n_tokens"], r["ids_crc32"]) for r in got[doc]]
    by_start = sorted((r["start"], doc) for doc, rs in got.items() for r in rs)
    ids = [d for _, d in by_start if d is not None]
    assert ids == sorted(ids) and by_start[0][1] is None


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\0\u00a0\u2028\x1c\x85aZs9'.,éª"), st.characters(exclude_categories=("Cs",))), max_size=30), max_size=4))
def test_ids_of_pieces_are_those_of_the_text(texts):
    encoder = range_coder._encoder(P.path(range_coder.TOKENIZER))
    whole = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode_all(texts)] == whole


def test_what_is_remembered_is_bounded(monkeypatch):
    encoder = range_coder._Encoder(P.path(range_coder.TOKENIZER))
    monkeypatch.setattr(encoder, "REMEMBERED", 50)
    for k in range(20):
        text = prose(k, 40)
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder.pieces) < 150 and len(encoder.words) < 250


def _plain_coder(ids, space):
    """Code lengths of the definition, lane by lane and id by id: the same model, held in dictionaries of this test."""
    n = len(ids)
    lanes, steps = range_coder._lanes(n)
    two, one, counts, trust = {}, {}, [1] * space, [[1, 1, 1] for _ in range(32)]
    shared = {}
    bits = 0.0
    for t in range(steps):
        if t <= 8 or t % 4 == 0:
            shared = {"counts": list(counts), "trust": [list(x) for x in trust]}
        learnt2, learnt1, added = {}, {}, []
        for lane in range(lanes):
            at = lane * steps + t
            if at >= n:
                continue
            x = int(ids[at])
            b1, b2 = (int(ids[at - 1]) if t > 0 else space), (int(ids[at - 2]) if t > 1 else space)
            slot = ((((b2 * 0x9E3779B1 + b1) % 2**64) * 0x9E3779B97F4A7C15) % 2**64) >> (64 - range_coder._SLOTS)
            (c2, s2), (c1, s1) = two.get(slot, (0, 0)), one.get(b1, (0, 0))
            context = s2 * 8 + s1 * 2 + (c1 == c2)
            outcome = 0 if x == c2 else 1 if x == c1 else 2
            row = shared["trust"][context]
            share = [v * (4096 - 3) // sum(row) + 1 for v in row]
            share[2] += 4096 - sum(share)
            bits -= np.log2(share[outcome] / 4096)
            if outcome == 2:
                bits -= np.log2(shared["counts"][x] / sum(shared["counts"]))
            added.append((context, outcome, x))
            for learnt, key, held, sure in ((learnt2, slot, c2, s2), (learnt1, b1, c1, s1)):
                candidate, _ = learnt.get(key, (held, sure))
                right = held == x
                if not right and sure == 0:
                    candidate = x
                learnt[key] = (candidate, min(sure + 1, 3) if right else max(sure - 1, 0))
        two.update(learnt2)
        one.update(learnt1)
        for context, outcome, x in added:
            trust[context][outcome] += 1
            if outcome == 2:
                counts[x] += 32
    return bits, lanes


@pytest.mark.parametrize("n", [1, 300, 3000])
def test_frames_are_as_long_as_the_definition_says(n):
    ids = np.random.default_rng(n).zipf(1.4, n) % 300
    bits, lanes = _plain_coder(ids, 300)
    frame = 8 * (len(range_coder.encode_block(ids, 300)) - range_coder._HEAD.size)
    # a lane's length, its last three words, and what ranges lose where they are cut short
    assert bits <= frame <= bits * 1.01 + lanes * (32 + 64)


def test_a_very_long_document_comes_back():
    # its counts add up to more than 2**27
    ids = np.random.default_rng(1).integers(0, 50_257, 4_400_000)
    assert (range_coder.decode_block(range_coder.encode_block(ids, 50_257)) == ids).all()


def test_full_counts_stay(monkeypatch):
    ids = np.random.default_rng(2).integers(0, 900, 20_000)
    sizes = []
    for full in (1 << 30, 40_000):
        monkeypatch.setattr(range_coder, "_FULL", full)
        frame = range_coder.encode_block(ids, 1000)
        sizes.append(len(frame))
        assert (range_coder.decode_block(frame) == ids).all()
    assert sizes[0] != sizes[1]


def test_only_ids_in_use_are_summed_and_searched():
    space, seen, rng = 5000, set(), np.random.default_rng(3)
    model = range_coder.Model(space)
    before = np.full(60, space)
    for _ in range(30):
        ids = rng.zipf(1.3, 60) % space
        model.predict(before, before)
        model.learn(ids, np.zeros(60, np.int64), ids)
        seen.update(ids.tolist())
        if model.written:
            continue
        assert model.used == len(seen) and set(model.id_at[: model.used].tolist()) == seen
        assert (model.place[model.id_at] == np.arange(space)).all()
        start, width = model.stretch(np.arange(space))
        assert start[0] == 0 and (start[1:] == (start + width)[:-1]).all() and start[-1] + width[-1] == model.total
        marks = np.arange(int(model.total), dtype=np.uint64)
        assert (model.find(marks) == np.searchsorted(start, marks, side="right") - 1).all()


@pytest.mark.parametrize("letters", ["абвгде", "abcdef", "àéîõüÿ", "a’б÷×ß"])
@pytest.mark.parametrize("end", [" ", "\n"])
def test_new_words_go_to_the_tokenizer_together(letters, end, monkeypatch):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list(letters), 6)) for _ in range(1500)]
    text = "".join(w + " " if i % 2 else w + end for i, w in enumerate(words))[:-1]
    encoder = range_coder._Encoder(P.path(range_coder.TOKENIZER))
    want, asked, ids_of = encoder.tokenizer.encode(text, add_special_tokens=False).ids, [], encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda texts: asked.extend(texts) or ids_of(texts))
    half = text[: text.index(" ", 5000)]
    got = encoder.encode_all([half, text])
    assert np.frombuffer(got[1], "<u4").tolist() == want and np.frombuffer(got[0], "<u4").tolist() == want[: len(got[0]) // 4]
    assert len(asked) < 20


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["one", " ", " two", "\n", "\n\n", "'s", "' re", "×", "÷a", "é", "<|endoftext|>", "7", "!?", "…", "\u2003", "字"]), max_size=12).map("".join)), min_size=3, max_size=6),
    st.integers(0, 2),
)
def test_ids_of_slices_of_arrow_are_those_of_the_texts(texts, skipped):
    encoder = range_coder._encoder(P.path(range_coder.TOKENIZER))
    got = encoder.encode_all(pa.array(texts, pa.string()).slice(skipped))
    whole = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts[skipped:]]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == whole


def test_token_files_of_no_rows(none):
    assert range_coder.read_ids(range_coder.write_ids(none)).count() == 0


# --- language


def _bits(counts, text):
    """Code length by the definition, symbol for symbol."""
    data, total = ppm.START + text.encode(), 0.0
    for i in range(3, len(data)):
        for k in (3, 2, 1, 0, -1):
            if k < 0:
                total += 8
                break
            followers = counts.get(data[i - k : i] if k else b"", {})
            n, d = sum(followers.values()), len(followers)
            if data[i] in followers:
                total += np.log2((n + d) / followers[data[i]])
                break
            if n:
                total += np.log2((n + d) / d)
    return total


def test_code_lengths_follow_the_definition():
    texts = {"a": ["the cat sat on the mat", "that hat"], "b": ["der hund und die katze", "über"]}
    trees = ppm.grow(list(texts), [ppm.gram_counts(t) for t in texts.values()])
    tried = ["the katze", "zzz", "t", "über the mat und " * 3]
    data = [ppm.START + t.encode() for t in tried]
    starts = np.cumsum([0, *map(len, data)])[:-1]
    got = trees.bits(np.frombuffer(b"".join(data), np.uint8), starts)
    for j, known in enumerate(texts.values()):
        counts = {}
        for t in known:
            d = ppm.START + t.encode()
            for i in range(3, len(d)):
                for k in range(4):
                    c = counts.setdefault(d[i - k : i] if k else b"", {})
                    c[d[i]] = c.get(d[i], 0) + 1
        assert np.allclose(got[:, j], [_bits(counts, t) for t in tried])


def test_language_of_held_out_rows(spark):
    of = {"en": "the weather is nice and the sea was calm with ", "de": "das wetter ist schoen und die see war ruhig mit "}
    data = [(i, of[lang] * 2 + prose(i, 5), lang) for i in range(200) for lang in [("en", "de")[i % 2]]]
    got = ppm.predictions(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()
    held = [r for r in got if r["held_out"]]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert np.mean([r["lang_pred"] == ("en", "de")[r["doc_id"] % 2] for r in held]) > 0.95


def test_language_of_odd_rows(odd, odd_rows, none):
    got = ppm.predictions(odd).collect()
    assert len(got) == len(odd_rows)
    found = {r["doc_id"]: r["lang_pred"] for r in got}
    assert all(found[i] == "und" for i in (4, 5, 7, -3)) and found[1] in ("en", "de", "fr")
    assert all(0 <= r["score"] <= 1 for r in got)
    assert ppm.accepted(odd).columns == odd.columns
    assert ppm.predictions(none).count() == 0
    assert {r["lang_pred"] for r in ppm.predictions(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_no_text_rules_the_learning_sample(spark):
    data = [(i, "kala vesi " * (50_000 if i % 3 else 3), "fi") for i in range(60)] + [(100 + i, "\u65e5\u672c" * 9_000, "ja") for i in range(60)]
    sample = ppm._sample(spark.createDataFrame(data, "doc_id long, text string, lang string"), 40, 20_000).collect()
    for lang in ("fi", "ja"):
        sizes = [len(r["text"].encode()) for r in sample if r["lang"] == lang]
        assert sum(sizes) <= 20_000 and len(sizes) >= 20 and max(sizes) <= 4 * 20_000 // ppm.TEXT_SHARE


# --- quality


def test_quality_of_held_out_rows(spark):
    data = [(i, prose(i, 80) if i % 3 else "$$$ %%% " * 40 + prose(i, 10)) for i in range(900)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(900)], "doc_id long, quality int, toxic int")
    got = [r for r in boosted.predictions(docs, labels).collect() if r["held_out"]]
    assert got and np.mean([r["predicted"] == int(r["doc_id"] % 3 > 0) for r in got]) > 0.97


def test_flat_traversal_equals_a_walk():
    r = np.random.default_rng(5)
    x = r.normal(size=(400, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    forest = boosted.grow(x, y, trees=20)

    def walk(row):
        total = forest.start
        for f, t, leaf in zip(forest.feature, forest.threshold, forest.leaf, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            total += leaf[node - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(forest.score(x), [walk(row) for row in x])
    assert ((forest.score(x) > 0.5) == y).mean() > 0.9


def test_quality_of_odd_rows(spark, odd, odd_rows, none):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, None), (2, 0, 1), (2, 1, 1)], "doc_id long, quality int, toxic int")
    got = boosted.predictions(odd, labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert boosted.accepted(odd, labels).columns == odd.columns
    assert boosted.predictions(none, labels).count() == 0
    assert {r["score"] for r in boosted.predictions(odd, labels.limit(0)).collect()} == {0.5}


# --- fingerprints


def _spots(text):
    import re

    common = set(spotsigs.ANCHORS)
    ws = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    out = set()
    content = [w for w in ws if w not in common]
    if content:
        out.add(("", *content[:2]))
    for i, w in enumerate(ws):
        if w in common:
            c = [x for x in ws[i + 1 : i + 9] if x not in common][:2]
            if c:
                out.add((w, *c))
    return out


def test_fingerprints_and_edits(spark):
    base = "the cat of the house is on the mat and it was a good day for the dog with {} in the garden but not in the {} of {} we saw"
    data = [(i, base.format(f"x{i}", f"y{i % 3}", f"z{i}") + " " + prose(i, i)) for i in range(12)] + [(40, None), (41, ""), (42, "?!"), (43, "ab")]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in spotsigs.fingerprints_and_edits(docs).collect()}
    order = sorted(data, reverse=True)
    for (i, text), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        text, after, r = text or "", after or "", got[i]
        m = len(text) // 3
        edited = text[: len(text) - m] + after[:m]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        if i < 40:
            for other, near in ((edited, "near_edited"), (after, "near_next")):
                a, b = _spots(text), _spots(other)
                if b:
                    assert r[near] == pytest.approx(len(a & b) / len(a | b))
    assert got[40]["fingerprint"] == got[41]["fingerprint"] and got[40]["near_edited"] == 1.0
    plan = spotsigs.fingerprints_and_edits(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_fingerprints_of_odd_rows(odd, odd_rows, none):
    got = spotsigs.fingerprints_and_edits(odd).collect()
    assert len(got) == len(odd_rows)
    prints = {}
    for r in got:
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert prints[1] == prints[2] and prints[1] != prints[6]
    assert spotsigs.fingerprints_and_edits(none).count() == 0


def test_words_out_of_an_anchors_reach_enter_the_fingerprint(spark):
    long = prose(5, 120).split()
    far = [*long[:100], "other", *long[101:]]
    filled = [f"kala{j}" for j in range(16)]
    texts = [
        " ".join(long), " ".join(far), " ".join([*long[:2], *prose(6, 118).split()]), "kala vesi maa", "kala vesi tuli",
        " ".join(["the", *filled, "of", "cat"]), " ".join(["the", *filled[:-1], "x", "of", "cat"]), " ".join(["the", *filled[:-1], "of", "cat"]),
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select("i", spotsigs.signatures(F.col("text")).alias("s"))
    got = {r["i"]: set(r["s"]) for r in frame.collect()}

    def grams(ws):
        return {tuple(ws[i : i + 3]) for i in range(len(ws))}

    assert len(got[0]) == len(grams(long)) + 1
    a, b = grams(long), grams(far)
    assert len(got[0] & got[1]) == len(a & b) + 1 and len(got[0] | got[1]) == len(a | b) + 1
    assert len(got[0] & got[2]) < 0.1 * len(got[0] | got[2])
    assert got[3] != got[4]
    assert got[5] != got[6] and len(got[5]) == 3 + 8
    assert len(got[7]) == 3  # the first words, and the two anchors


def test_alike_fingerprints_meet(spark):
    def text(k, changed=()):
        return " ".join(f"the word{k}x{j}{'q' if j in changed else ''} of thing{k}x{j}" for j in range(60))

    data = [(10 * k + v, text(k, range(v))) for k in range(4) for v in range(5)] + [(90, text(7)), (91, text(7)), (92, None)]
    got = {r["doc_id"]: r["component_id"] for r in spotsigs.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    sets_ = {i: _spots(t) for i, t in data}
    comp = {i: i for i, _ in data}
    for _ in data:
        for i in comp:
            for j in comp:
                if sets_[i] and sets_[j] and len(sets_[i] & sets_[j]) >= 0.8 * len(sets_[i] | sets_[j]):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    assert got == comp


def test_open_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "BLOCK", 4)
    members = spark.createDataFrame([(7, 10, f"d{k}", k, k % 3) for k in range(40)], "bucket long, blocks int, d string, rep long, c long")
    left, right = spotsigs._blocks(members)
    assert max(r["count"] for side in (left, right) for r in side.groupBy("bucket", "i", "j").count().collect()) < 20
    met = left.join(right, ["bucket", "i", "j"]).filter("i < j OR x < y").collect()
    assert len(met) == 40 * 39 // 2 == len({frozenset((r["a"], r["b"])) for r in met})

    # one rare signature in all, so they share a bucket; its smallest member is like none of the others
    def text(k):
        return "the rare pair " + " ".join(f"of word{k // 2}x{j} in thing{k // 2}x{j}" for j in range(9)) + f" the last{k}"

    data = [(k, text(k)) for k in range(1, 31)]
    got = {r["doc_id"]: r["component_id"] for r in spotsigs.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 0.8).collect()}
    sets_ = {i: _spots(t) for i, t in data}
    assert got == {i: min(j for j in sets_ if len(sets_[i] & sets_[j]) >= 0.8 * len(sets_[i] | sets_[j])) for i in sets_}
    assert len(set(got.values())) < len(got)


# --- one split at a time


def _grown(x, y, trees, depth, rate):
    """Trees by trying every feature and cut at every node, row by row."""
    n = len(y)
    share = (sum(y) + 1) / (n + 2)
    total = [float(np.log(share / (1 - share)))] * n
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, boosted.BINS + 1)[1:-1])) for j in range(x.shape[1])]
    for _ in range(trees):
        p = [1 / (1 + np.exp(-t)) for t in total]
        g, h = [a - b for a, b in zip(y, p, strict=True)], [b * (1 - b) for b in p]
        groups = [list(range(n))]
        for _ in range(depth):
            below = []
            for rows_ in groups:
                best = (1e-6, None, None)
                for j, points in enumerate(cuts):
                    for cut in points:
                        low, high = [i for i in rows_ if x[i, j] <= cut], [i for i in rows_ if x[i, j] > cut]
                        if min(len(low), len(high)) < boosted.MIN_ROWS:
                            continue
                        score = [sum(g[i] for i in part) ** 2 / (sum(h[i] for i in part) + 1) for part in (low, high, rows_)]
                        gain = score[0] + score[1] - score[2]
                        if gain > best[0] * (1 + 1e-9):
                            best = (gain, low, high)
                below += [rows_, []] if best[1] is None else [best[1], best[2]]
            groups = below
        for rows_ in groups:
            value = rate * sum(g[i] for i in rows_) / (sum(h[i] for i in rows_) + 1)
            for i in rows_:
                total[i] += value
    return [1 / (1 + np.exp(-t)) for t in total]


def test_trees_are_those_of_trying_every_split():
    r = np.random.default_rng(6)
    x = np.round(r.normal(size=(260, 3)), 1)
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + r.normal(size=260) > 0.3).astype(float)
    forest = boosted.grow(x, y, trees=3, depth=2, rate=0.3)
    assert forest.score(x) == pytest.approx(_grown(x, y, 3, 2, 0.3), abs=1e-9)


# --- packing


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 3))), max_size=40))
def test_best_fit_takes_the_tightest_compatible_bin(found):
    pieces = [packing.Piece(*p) for p in sorted(found, key=lambda p: -p[0])]
    got = packing.best_fit(pieces, 12)
    held: list[list[packing.Piece]] = []
    for piece, number in zip(pieces, got, strict=True):
        fits = [
            (12 - sum(p.length for p in bin_), n)
            for n, bin_ in enumerate(held)
            if sum(p.length for p in bin_) + piece.length <= 12
            and not any(p.source == piece.source is not None or p.cluster == piece.cluster is not None for p in bin_)
        ]
        if number == len(held):
            assert not fits
            held.append([])
        else:
            assert (12 - sum(p.length for p in held[number])) == min(fits)[0] and any(n == number for _, n in fits)
        held[number].append(piece)


def test_packing_of_odd_rows(odd, odd_rows, none):
    got = packing.pack(odd, capacity=100, shard_docs=10).collect()
    words = Counter()
    for r in got:
        words[r["doc_id"]] += r["n_words"]
    want = Counter()
    for doc, text, *_ in odd_rows:
        want[doc] += len((text or "").encode().split())
    assert words == want and len({r["doc_id"] for r in got}) == len({r[0] for r in odd_rows})
    full = Counter()
    for r in got:
        full[r["shard"], r["bin"]] += r["n_words"]
    assert max(full.values()) <= 100
    assert packing.pack(none).count() == 0
    assert rows(packing.pack(odd, capacity=100), "doc_id", "piece", "bin") == rows(packing.pack(odd.repartition(7), capacity=100), "doc_id", "piece", "bin")
