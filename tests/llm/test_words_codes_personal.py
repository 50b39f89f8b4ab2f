"""Spelling variants, vector codes, personal data: against brute force, on odd inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import difference, duck
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from lociflow.llm import bitmask_codes, personal, queries, spelling

from .conftest import CLASHING, prose

# --- spelling variants


def _edits(a, b):
    """Exactly one inserted, deleted or replaced code point, by the definition."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _variants(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    near = {w: [v for v in n if _edits(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


def _got(frame):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"]) for r in frame.collect())


def _misspelt(seed, n):
    r = random.Random(seed)
    stems = ["".join(r.choice("aeoénrst") for _ in range(r.randint(6, 12))) for _ in range(40)]
    out = []
    for i in range(n):
        ws = []
        for _ in range(40):
            w = stems[min(int(r.expovariate(0.25)), 39)]
            while r.random() < 0.15:
                k = r.randrange(len(w))
                w = r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice("aeoé×") + w[k:], w[:k] + "x" + w[k + 1 :]])
            ws.append(w.title() if r.random() < 0.1 else w)
        out.append((i, r.choice([" ", ", ", "9", "ā"]).join(ws)))
    return out


@pytest.mark.parametrize("block", [spelling.BLOCK, 3])
def test_variants_are_those_of_all_pairs(spark, block):
    """Blocks of three words cut most groups, so that pairs of blocks are compared as well."""
    docs = _misspelt(5, 120)
    got = _got(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string"), block))
    want = _variants(docs)
    assert got == want
    assert any(f for _, f, *_ in want) and any(w != r and f != r for w, f, r, *_ in want if f)


def test_variants_of_odd_rows(odd, odd_rows):
    assert _got(spelling.variants(odd)) == _variants([r[:2] for r in odd_rows])


def test_variants_of_no_rows(none):
    assert spelling.variants(none).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text("abÿ", min_size=1, max_size=9), st.text("abÿ", min_size=1, max_size=9))
def test_tile_tells_one_edit(a, b):
    if a != b:
        near, _, _ = spelling.Tile([a, b]).compare(np.array([0]), np.array([1]))
        assert bool(near[0]) == _edits(a, b)


def test_a_pair_comes_out_once(spark):
    words = spark.createDataFrame([("aaaaaaa", 2), ("aaaaaaaa", 3), ("aaaaaaaaa", 4), ("aaaabaaa", 5)], "word string, n long")
    got = rows(spelling.near_pairs(words), "word", "other")
    assert got == sorted(set(got))
    assert set(got) == {(a, b) for a in ("aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aaaabaaa") for b in ("aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aaaabaaa") if a != b and _edits(a, b)}


def test_very_long_words(spark):
    long = "abcdefghij" * 3000
    words = spark.createDataFrame([(long, 2), (long[:20_000] + "x" + long[20_000:], 3), (long[1:], 4), ("shorter", 5), ("shortest", 5)], "word string, n long")
    assert {(len(a), len(b)) for a, b in rows(spelling.near_pairs(words), "word", "other")} == {(30_000, 30_001), (30_001, 30_000), (30_000, 29_999), (29_999, 30_000)}


# --- vector codes


def _codes(vectors):
    kept = [(i, lab, [int(np.floor(256 * float(x))) for x in v]) for i, v, lab in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = len(kept[0][2]) // 16
    first = sorted(kept, key=lambda r: r[0])[:64]
    books = [[r[2][p * width : (p + 1) * width] for r in first] for p in range(16)]

    def near(p, part):
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(2):
        members = defaultdict(list)
        for _, _, v in kept:
            for p in range(16):
                part = v[p * width : (p + 1) * width]
                members[p, near(p, part)[1]].append(part)
        for (p, k), parts in members.items():
            books[p][k] = [sum(c) // len(parts) for c in zip(*parts, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], Counter()
    for i, lab, v in kept:
        found = [near(p, v[p * width : (p + 1) * width]) for p in range(16)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab))
        by_label[lab] += out[-1][2]
    return sorted((i, c, e, by_label[lab], sha) for i, c, e, lab in out)


def _vectors(seed, n, dims=48):
    r = np.random.default_rng(seed)
    out = [(i * 7 % 1009, (r.normal(size=dims) * r.choice([0.05, 1, 30])).tolist(), [None, 0, 1, 2][i % 4]) for i in range(n)]
    # ties: equal vectors and whole numbers
    out += [(5000 + i, [float(i % 2)] * dims, 1) for i in range(20)]
    return [*out, (6000, None, 1), (6001, [float("nan")] * dims, 1), (6002, [None] + [0.0] * (dims - 1), None), (6003, [float("-inf")] * dims, 2)]


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("n", [300, 30])
def test_codes_are_those_of_plain_comparison(spark, n):
    vectors = _vectors(n, n)
    frame = spark.createDataFrame(vectors, SCHEMA).repartition(5)
    assert rows(bitmask_codes.compressed(frame)) == _codes(vectors)


def test_codes_with_clashing_columns_and_without_rows(spark):
    frame = spark.createDataFrame(_vectors(1, 40), SCHEMA)
    wide = frame.selectExpr("*", *(f"1 as {c}" for c in ("code", "error", "of", "part", "entry", "n", "sums", "a") if c not in frame.columns), "2 as `x.y`")
    assert rows(bitmask_codes.compressed(wide)) == rows(bitmask_codes.compressed(frame))
    assert bitmask_codes.compressed(frame.limit(0)).columns == bitmask_codes.compressed(frame).columns
    assert bitmask_codes.compressed(frame.limit(0)).count() == 0


def test_codes_of_odd_lengths_and_sizes(spark):
    """Shorter vectors are filled up, giants are cut at the greatest size, missing ids come last."""
    frame = spark.createDataFrame([(1, [1.0] * 17, 0), (2, [1.0] * 16, 0), (None, [1e300] * 32, None), (None, [-1e300] * 32, None), (3, [], 5)], SCHEMA)
    got = {(r["vec_id"], r["label_error"]): r["code"] for r in bitmask_codes.compressed(frame).collect()}
    assert len(got) == 4 and all(len(c) == 32 for c in got.values())
    only_empty = bitmask_codes.compressed(spark.createDataFrame([(1, [], 0), (2, [], 0)], SCHEMA)).collect()
    assert [(r["code"], r["error"]) for r in only_empty] == [("00" * 16, 0)] * 2


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 64), st.integers(1, 5), st.sampled_from([1, 4, 1000, 1 << 26]), st.integers(0, 1000))
def test_slices_find_the_nearest(n, width, size, seed):
    r = np.random.default_rng(seed)
    entries, parts = r.integers(-size, size + 1, (n, width)), r.integers(-size, size + 1, (50, width))
    which, away = bitmask_codes.Slices(entries).nearest(parts)
    d = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (which == d.argmin(axis=1)).all() and (away == d.min(axis=1)).all()


def test_decoded_codes_are_near(spark):
    frame = bitmask_codes.kept(spark.createDataFrame(_vectors(3, 200), SCHEMA))
    books = bitmask_codes.codebooks(frame)
    back = bitmask_codes.encode(frame, books).withColumn("back", bitmask_codes.decode("code", books)).join(frame, "vec_id")
    for r in back.select("embedding", "back", "error").limit(20).collect():
        assert abs(np.sum((np.array(r[0]) - np.array(r[1])) ** 2) * 256**2 - r[2]) <= 2 * (r[2] ** 0.5) * 7 + 48


def test_codes_equal_their_sql(spark):
    got = queries.QUERIES["op12_bitmask_codes"](spark, "/root/testdata/sf0.001")
    assert difference(got, duck("/root/testdata/sf0.001"), queries.SQL["op12_bitmask_codes"]) is None


# --- personal data

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _base(text):
    """The contract's patterns as they stand."""

    def holds(kind, found):
        digits = [int(c) for c in found if c in "0123456789"]
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            doubled = [x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(digits))]
            return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    out = [(m.start(), k, m.end()) for k, (kind, form) in enumerate(FORMS.items()) for m in re.finditer(form, text or "") if holds(kind, m.group())]
    return sorted(out)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.sampled_from("0123456789..@@+- ()aZ_%é,"), max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert personal.base(text) == _base(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["4242424242424242", "1.2.3.4", "256.1.1.1", "a@b.c", "@", ".", "-", " ", "+1 (132) 555-1352", "9" * 12, "a.b", "_"]), max_size=12).map("".join))
def test_base_spans_of_pieces(text):
    spans = personal.base(text)
    assert spans == _base(text)
    for a, b in personal.others(text, spans):
        assert 0 <= a < b <= len(text) and not any(x < b and a < y for x, _, y in spans)


def test_long_texts_take_linear_time():
    for text in ("a" * 1_000_000 + "@", "1" * 1_000_000, "1." * 500_000, "a@" * 300_000, "+1 " * 300_000, "(1) " * 200_000):
        personal.others(text, personal.base(text))


def _told(spans):
    return ",".join(f"{list(FORMS)[k]}:{a}:{b}" for a, k, b in spans)


def _lines():
    """Mails, phones and addresses in telling surroundings; of each kind some that the forms don't know."""
    out = []
    for i in range(12):
        out.append(f"{prose(i, 5)} write to mail u{i}@host{i}.example.com or leave it {prose(99 + i, 4)}")
        out.append(f"{prose(i, 6)} please call us under +1 (200) 555-10{i:02d} until noon {prose(70 + i, 4)}")
        out.append(f"order number {i} costs {i + 3} and weighs 7{i} {prose(40 + i, 5)}")
    out.append("x write to mail root@localhost or leave it y")
    out.append("x please call us under 200 555 1099 until noon y")
    out.append("x write to mail 1234 or leave it y")
    out.append("once more root@localhost in other words")
    return list(enumerate(out))


def test_contexts_discover_what_the_forms_do_not_know(spark):
    docs = _lines()
    got = {r["doc_id"]: r for r in personal.personal_data(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    added = {}
    for i, text in docs:
        base = _base(text)
        assert got[i]["base_sha256"] == hashlib.sha256(_told(base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in FORMS] == [sum(s[1] == k for s in base) for k in range(4)]
        spans = got[i]["spans"].split(",") if got[i]["spans"] else []
        more = set(spans) - set(_told(base).split(","))
        assert len(spans) == len(base) + got[i]["n_added"] == len(base) + len(more)
        for s in more:
            kind, a, b = s.split(":")
            added.setdefault(text[int(a) : int(b)], set()).add(kind)
    assert added == {"root@localhost": {"email"}, "200 555 1099": {"phone"}}
    assert got[len(docs) - 1]["n_added"] == 1


def _bootstrapped(graph, rounds):
    """The rounds over a set of edges, in plain Python."""
    size = Counter(p for p, _ in {(p, i) for p, i, _ in graph})
    graph = {e for e in graph if size[e[0]] >= personal.SUPPORT}
    known = {i for _, i, k in graph if k}
    score = {}
    for _ in range(rounds):
        held = [(p, k, 1.0) for p, _, k in graph if k]
        held += [(p, k, s) for p, i, kind in graph if kind is None and i not in known for (j, k), s in score.items() if j == i]
        total, good = Counter(), Counter()
        for p, k, s in held:
            total[p, k] += s
            good[p, k] += s >= 0.5
        patterns = {pk: s / size[pk[0]] for pk, s in total.items() if good[pk] >= personal.SUPPORT and s / size[pk[0]] >= personal.CONFIDENCE}
        doubt = defaultdict(lambda: 1.0)
        for p, i, kind in graph:
            for (q, k), c in patterns.items():
                if q == p and kind is None and i not in known and re.search(personal.LOOKS[k], i):
                    doubt[i, k] *= 1 - min(c, personal.TRUST)
        score = {ik: 1 - d for ik, d in doubt.items()}
    best = {}
    for (i, k), s in score.items():
        if s >= personal.SURE:
            best[i] = min(best.get(i, (0.0, 9, "")), (-s, personal.KINDS.index(k), k))
    return {p: round(c, 9) for p, c in patterns.items()}, {i: b[2] for i, b in best.items()}


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_scores_of_the_graph(spark, rounds):
    r = random.Random(3)
    graph = set()
    for p in range(30):
        kind = r.choice(["email", "phone", None])
        for _ in range(r.randint(1, 9)):
            n = r.randint(0, 40)
            known = {0: "email", 1: "phone"}.get(n % 4)
            what = f"u{n}@h" if n % 2 == 0 else f"555 00{n:02d}"
            graph.add((f"p{p}", what, known if kind is None or r.random() < 0.9 else None))
    graph = {(p, i, k) for p, i, k in graph}
    patterns, found = personal.discovered(spark.createDataFrame(sorted(graph, key=str), "pattern string, instance string, kind string"), rounds)
    want = _bootstrapped(graph, rounds)
    assert {(x["pattern"], x["kind"]): round(x["confidence"], 9) for x in patterns.collect()} == want[0]
    assert {x["instance"]: x["kind"] for x in found.collect()} == want[1]


def test_personal_data_of_odd_rows(odd, odd_rows, none):
    got = personal.personal_data(odd).collect()
    assert Counter((r["doc_id"], r["spans"]) for r in got) == Counter((r[0], _told(_base(r[1]))) for r in odd_rows)
    assert personal.personal_data(none).count() == 0
    assert set(CLASHING) & set(odd.columns)
