"""Hard negatives, spelling variants and packing against plain versions of their definitions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martloom.llm import linear_packing, permuterm_spelling, rtree_negatives
from martloom.llm.queries import BPE_PATTERN, PACKING_RANKS
from tests.llm.helpers import AWKWARD, documents, rows, with_clashes

VECTORS = "vec_id bigint, embedding array<float>, label int"


# --- hard negatives

def plain_negatives(table, every=100):
    """By the definition, over (vec_id, embedding, label) with one row an id."""
    kept = {}
    for vec_id, vector, label in table:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = ((label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in vector])
        kept[vec_id] = min(kept.get(vec_id, row), row)
    out = []
    for a, (label, q) in kept.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, other)), i, lab) for i, (lab, other) in kept.items() if i != a and len(other) == len(q))
        for minus, p, _ in [s for s in scored if s[2] == label][:5]:
            fitting = [s for s in scored if s[2] != label and 80 * -minus <= 100 * -s[0] <= 100 * -minus][:5]
            out += [(a, p, rank, n, -minus, -score) for rank, (score, n, _) in enumerate(fitting, 1)]
    return sorted(out)


def clustered(n, width, seed, near=0.3):
    """Vectors around a few centres, on a coarse grid so that scores tie."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(5, width))
    vectors = centres[draw.integers(0, 5, n)] + near * draw.normal(size=(n, width))
    vectors = np.round(vectors / np.linalg.norm(vectors, axis=1, keepdims=True) * 8) / 8
    return [(i, [float(x) for x in v], int(label)) for i, (v, label) in enumerate(zip(vectors, draw.integers(0, 3, n)))]


@pytest.mark.parametrize("width, near", [(4, 0.3), (16, 0.05), (3, 1.0)])
def test_negatives_by_brute_force(spark, width, near):
    table = clustered(1500, width, width, near)
    df = with_clashes(spark.createDataFrame(table, VECTORS), ("q", "home", "slot", "place", "low", "high", "block"))
    got = rtree_negatives.hard_negatives(df, size=200, groups=3, block=4)
    expected = plain_negatives(table)
    assert expected and rows(got) == expected


def test_negatives_of_awkward_rows(spark):
    table = clustered(300, 4, 1)
    table += [(None, [1.0] * 4, 1), (301, None, 1), (302, [1.0, None, 0.0, 0.0], 1), (303, [float("nan")] * 4, 1),
              (304, [float("inf"), 0.0, 0.0, 0.0], 1), (305, [1.0] * 4, None), (400, [0.0] * 4, 1), (401, [0.0] * 4, 2),
              (500, [], 1), (501, [], 1), (502, [], 2), (600, [1.0, 2.0], 0), (601, [1.0, 2.0], 0), (602, [1.0, 1.75], 2),
              (700, [-1.0] * 4, 0), (-100, [0.5] * 4, 2), table[0], table[3], (3, [9.0] * 4, 1)]
    got = rtree_negatives.hard_negatives(spark.createDataFrame(table, VECTORS), size=64, groups=2)
    assert rows(got) == plain_negatives(table)
    assert rtree_negatives.hard_negatives(spark.createDataFrame([], VECTORS)).collect() == []
    assert rtree_negatives.hard_negatives(spark.createDataFrame([(1, [1.0], 1)], VECTORS)).collect() == []


def test_negatives_of_equal_vectors(spark):
    """A third of all rows share a vector and a label; every score ties."""
    table = [(i, [0.5, 0.25] if i % 3 == 0 else [i % 7 / 8, 0.5], i % 3) for i in range(900)]
    got = rtree_negatives.hard_negatives(spark.createDataFrame(table, VECTORS), size=100)
    assert rows(got) == plain_negatives(table)


def test_negatives_by_their_sql(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    names = "anchor_id, positive_id, rank, negative_id, positive_score, negative_score"
    expected = con.execute(f"SELECT {names} FROM ({rtree_negatives.SQL})").fetchall()
    assert expected and rows(rtree_negatives.hard_negatives(df, size=64)) == sorted(expected)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 400), st.integers(1, 6), st.sampled_from([8, 1 << 20, 1 << 27]), st.integers(0, 10_000))
def test_a_tree_finds_what_a_scan_finds(n, width, reach, seed):
    draw = np.random.default_rng(seed)
    vectors, labels = draw.integers(-reach, reach + 1, (n, width)), draw.integers(0, 3, n)
    order = rtree_negatives.tile_order(vectors)
    assert sorted(order.tolist()) == list(range(n))
    tree = rtree_negatives.PackedTree(order, labels[order], vectors[order])
    asked = vectors[:5]
    for same in (True, False):
        high = [int(reach * reach * x) for x in (9, 2, 1, 0.5, 0)][:len(asked)]
        low = [int(h * 0.8) - 5 for h in high]
        floor = [-(1 << 63), 3, -(1 << 63), 5, -(1 << 63)][:len(asked)]
        got = rtree_negatives.search(tree, rtree_negatives.Queries(asked, labels[:5], range(len(asked)), low, high, floor, same), 4)
        for i, found in enumerate(got):
            scan = [(sum(int(x) * int(y) for x, y in zip(asked[i], vectors[j])), -j) for j in range(n) if j != i and (labels[j] == labels[i]) == same]
            assert sorted(found, reverse=True) == sorted((s for s in scan if max(low[i], floor[i]) <= s[0] <= high[i]), reverse=True)[:4]


# --- spelling variants

def plain_words(table):
    counts = Counter()
    for doc_id, text in table:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(table):
    words = plain_words(table)
    form = {}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=lambda r: r[0])


NAMES = ("word", "form", "root", "n", "n_near", "form_n")


def test_variants_by_brute_force(spark):
    draw = random.Random(3)
    stems = ["balloon", "committee", "ähnlich", "straße", "aaaaaaa", "abcabc", "ÿÿÿÿÿÿ", "accommodate"]
    letters = "abcmnoÿàÀ"

    def vary(word, times):
        for _ in range(times):
            i, c = draw.randrange(len(word) + 1), draw.choice(letters)
            word = draw.choice([word[:i] + c + word[i:], word[:i] + word[i + 1:], word[:i] + c + word[i + 1:]])
        return word

    weighted = [(vary(s, k), 5 ** (3 - k)) for s in stems for k in (0, 1, 1, 2, 2, 2, 3) for _ in range(3)]
    table = [(i, " ".join(draw.choice((str.title, str.lower, str))(w) for w, n in draw.sample(weighted, 60) for _ in range(draw.randint(1, n))))
             for i in range(60)]
    table += [(60, "x" * 70 + " " + "x" * 71 + "1" + "x" * 64 + "," + "x" * 65 + "," + "x" * 63 + "y" + " " + "x" * 69 + "z")] * 6
    table += [(None, "balloon×balloons ÷÷÷÷÷÷÷ Ωballoon"), (None, None), (61, ""), (61, "balloom " * 400)] * 5
    got = permuterm_spelling.spelling_variants(with_clashes(documents(spark, table), ("prefix", "near", "form")))
    expected = plain_variants(table)
    assert rows(got, *NAMES) == expected
    assert any(r[1] and r[1] != r[2] for r in expected) and any(r[4] > 1 for r in expected)


def test_variants_of_the_sample(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    table = [(r.doc_id, r.text) for r in docs.collect()]
    got = rows(permuterm_spelling.spelling_variants(docs), *NAMES)
    assert got == plain_variants(table) and got


def test_variants_of_awkward_rows(spark):
    assert rows(permuterm_spelling.spelling_variants(documents(spark, AWKWARD)), *NAMES) == plain_variants(AWKWARD)
    assert permuterm_spelling.spelling_variants(documents(spark, [])).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=6), min_size=2, max_size=2, unique=True), st.sampled_from([0, 61, 64, 70]))
def test_rotations_meet_once_a_pair(pair, padding):
    """Two words one edit apart share exactly one range as neighbours, others none; also where ranges are hashed."""
    a, b = (w + "c" * padding for w in pair)
    met = defaultdict(list)
    for w in (a, b):
        for prefix, skipped, closing in permuterm_spelling.rotations(w):
            met[prefix].append((w, skipped, closing))
    shared = 0
    for members in met.values():
        for w, skipped, closing in members:
            for v, other, last in members:
                if w == a and v == b and (skipped and other or skipped and closing or other and last):
                    shared += 1
    assert shared == one_edit(a, b)


# --- packing

@pytest.fixture(scope="module")
def tokenizer():
    held = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    held.encode_special_tokens = True
    return held


def check_packing(got, table, tokenizer, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id, texts in table.items():
        pieces = sorted(by_doc.pop(doc_id), key=lambda r: r.piece)
        expected = []
        for text in texts:
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
            cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
            expected += [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in pieces) == sorted(expected)
    assert not by_doc
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=rooms.__getitem__)] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("capacity", [2048, 128, 7])
def test_packing_keeps_its_laws(spark, small, tokenizer, capacity):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    more = [*AWKWARD, (20, "a <|endoftext|> b"), (21, "word " * 2047), (22, "word " * 9000), *[(100 + i, "the same text") for i in range(400)]]
    both = docs.select("doc_id", "text").withColumn("doc_id", docs.doc_id + 1000).unionByName(documents(spark, more).select("doc_id", "text"))
    table = defaultdict(list)
    for r in both.collect():
        table[r.doc_id].append(r.text)
    got = linear_packing.pack(with_clashes(both, ("part", "nth", "length", "start", "of", "within", "before", "rank")).repartition(5),
                              PACKING_RANKS, BPE_PATTERN, capacity).collect()
    made = check_packing(got, table, tokenizer, capacity)
    lengths = [r.length for r in got]
    assert made <= best_fit_decreasing(lengths, capacity)
    assert made <= math.ceil(sum(lengths) / capacity * 1.01) + 1


def test_packing_of_no_rows(spark):
    assert linear_packing.pack(documents(spark, []), PACKING_RANKS, BPE_PATTERN).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 400), min_size=1, max_size=30), st.sampled_from(linear_packing.SCHEMES))
def test_every_plan_places_every_piece_once(counts, scheme):
    made, plan = linear_packing.grouped_plan(counts, *scheme, capacity=60)
    seen, fill = defaultdict(list), defaultdict(list)
    for length, rank, n, first, each, offset in plan.tolist():
        for j in range(n):
            seen[length].append(rank + j)
            fill[first + j // each].append((offset + j % each * length, length))
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert sorted(fill) == list(range(made))
    for held in fill.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 60


def test_configurations_cover_the_demand():
    sizes, demand = [90, 70, 55, 41, 30], [40, 31, 77, 12, 63]
    found = linear_packing.configurations(sizes, demand, 200)
    assert all(sum(n * s for n, s in zip(numbers, sizes)) <= 200 for numbers, _ in found)
    covered = [sum(numbers[i] * often for numbers, often in found) for i in range(5)]
    assert all(c >= d - 1e-6 for c, d in zip(covered, demand))
    assert sum(often for _, often in found) >= sum(s * d for s, d in zip(sizes, demand)) / 200 - 1e-9


def test_a_plan_does_not_grow_with_the_documents():
    draw = random.Random(1)
    few = {length: draw.randint(1, 9) for length in range(1, 2049, 7)}
    many = {length: n * 1_000_000_007 for length, n in few.items()}
    made, plan = linear_packing.packing_plan(many)
    assert len(plan) < 20_000 and plan[:, 2].sum() == sum(many.values())
    assert made <= sum(length * n for length, n in many.items()) / 2048 * 1.01
