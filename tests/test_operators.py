"""Operators against plain definitions on small random inputs."""

import datetime as dt
import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from martloom.operators import joins, ranking
from martloom.operators.changes import above_high_water, apply_cdc, mask, merge_by_key, retain, summing_read
from martloom.operators.dedup import dedup_any, latest_per_key
from martloom.operators.fuzzy import fuzzy_match
from martloom.operators.identity import identity_clusters
from martloom.operators.sessions import flag_bots, sessions_by_gap

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- dedup ------------------------------------------------------------------

def test_latest_per_key_breaks_ties_and_is_idempotent(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("a", 2, 6), ("b", None, 1), ("b", 0, 2)], "k string, t int, v int")
    once = latest_per_key(df, ["k"], "t", ["v"])
    assert rows(once) == [("a", 2, 6), ("b", 0, 2)]
    assert rows(latest_per_key(once, ["k"], "t", ["v"])) == rows(once)


def test_dedup_any_drops_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, v int")
    assert rows(dedup_any(df, "k")) == [("a", 1)]


# --- any-key join -----------------------------------------------------------

key = st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))


@few
@given(st.lists(st.tuples(key, key), max_size=12), st.lists(st.tuples(key, key), max_size=12))
def test_any_key_join_equals_or_join(spark, left_keys, right_keys):
    left = spark.createDataFrame([(i, *k) for i, k in enumerate(left_keys)], "id int, phone string, email string")
    right = spark.createDataFrame([(i, *k) for i, k in enumerate(right_keys)], "rid int, rp string, re string")
    got = joins.left_join_any_key(left, right, [("phone", "rp"), ("email", "re")], ["rid"], "id")
    want = left.join(right, (F.col("phone") == F.col("rp")) | (F.col("email") == F.col("re")), "left").select(
        "id", "phone", "email", "rid")
    assert rows(got) == rows(want)


def test_any_key_join_with_three_keys(spark):
    pool = [None, "p", "q"]
    combos = list(itertools.product(pool, repeat=3))
    left = spark.createDataFrame([(i, *c) for i, c in enumerate(combos)], "id int, a string, b string, c string")
    right = spark.createDataFrame([(i, *c) for i, c in enumerate(combos[::4])], "rid int, ra string, rb string, rc string")
    got = joins.left_join_any_key(left, right, [("a", "ra"), ("b", "rb"), ("c", "rc")], ["rid"], "id")
    on = (F.col("a") == F.col("ra")) | (F.col("b") == F.col("rb")) | (F.col("c") == F.col("rc"))
    assert rows(got) == rows(left.join(right, on, "left").select("id", "a", "b", "c", "rid"))


def test_any_key_join_keeps_repeated_rows(spark):
    left = spark.createDataFrame([(1, "p", None), (1, "p", None), (2, None, None), (2, None, None), (2, None, None), (3, "q", "e")],
                                 "id int, phone string, email string")
    right = spark.createDataFrame([(7, "p", "e"), (7, "p", "e"), (8, "q", "e")], "rid int, rp string, re string")
    keys = [("phone", "rp"), ("email", "re")]
    got = joins.left_join_any_key(left, right, keys, ["rid"], "id").select("id", "rid")
    assert sorted(rows(got), key=str) == [(1, 7)] * 4 + [(2, None)] * 3 + [(3, 7)] * 2 + [(3, 8)]
    assert rows(joins.left_join_any_key(left, right.limit(0), keys, ["rid"], "id").select("id").distinct()) == [(1,), (2,), (3,)]
    assert joins.left_join_any_key(left.limit(0), right, keys, ["rid"], "id").count() == 0


def test_blank_keys_match_nothing_when_asked(spark):
    left = spark.createDataFrame([(1, "", "e"), (2, "p", ""), (3, "", "")], "id int, phone string, email string")
    right = spark.createDataFrame([(7, "", ""), (8, "p", "e")], "rid int, rp string, re string")
    keys = [("phone", "rp"), ("email", "re")]
    plain = joins.left_join_any_key(left, right, keys, ["rid"], "id").select("id", "rid")
    asked = joins.left_join_any_key(left, right, keys, ["rid"], "id", blank_is_missing=True).select("id", "rid")
    assert rows(plain) == [(1, 7), (1, 8), (2, 7), (2, 8), (3, 7)]
    assert rows(asked) == rows(spark.createDataFrame([(1, 8), (2, 8), (3, None)], "id int, rid int"))


# --- tiles and ranks --------------------------------------------------------

@few
@given(st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=23))
def test_global_ntile_equals_ntile(spark, numbers):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(numbers)], "id int, v int")
    got = ranking.global_ntile(df, 5, {"tile": "v"}, ["id"]).select("id", "tile")
    want = df.select("id", F.ntile(5).over(Window.orderBy(F.asc_nulls_last("v"), "id")).alias("tile"))
    assert rows(got) == rows(want)


def test_global_ntile_with_identical_rows_keeps_tile_sizes(spark):
    df = spark.createDataFrame([(1, 7)] * 11 + [(2, 9)], "id int, v int")
    sizes = ranking.global_ntile(df, 5, {"tile": "v"}, ["id"]).groupBy("tile").count()
    assert rows(sizes) == [(1, 3), (2, 3), (3, 2), (4, 2), (5, 2)]


def test_rank_of_large_groups_equals_rank(spark):
    picks = random.Random(7)
    data = [(i, picks.choice("abc"), picks.choice([None, 1, 2, 2, 2, 3, 9])) for i in range(300)]
    df = spark.createDataFrame(data + [(999, None, 2)], "id int, g string, v int")
    got = ranking.rank_within(df, {"r": ["g"]}, "v").select("id", "r")
    want = df.select("id", F.rank().over(Window.partitionBy("g").orderBy(F.desc_nulls_last("v"))).alias("r"))
    assert rows(got) == rows(want)


def test_top_bottom_takes_both_ends(spark):
    df = spark.createDataFrame([("w", f"s{i}", i) for i in range(5)], "week string, store string, v int")
    got = ranking.top_bottom(df, ["week"], "v", "store", 2).select("side", "position", "store")
    assert rows(got) == [("bottom", 1, "s0"), ("bottom", 2, "s1"), ("top", 1, "s4"), ("top", 2, "s3")]


# --- sessions and bots ------------------------------------------------------

def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def test_sessions_split_only_after_more_than_the_gap(spark):
    df = spark.createDataFrame([("s", at(0), "a"), ("s", at(1800), None), ("s", at(3601), "b")], "k string, t timestamp, u string")
    got = sessions_by_gap(df, "k", "t", 30, {"n": F.lit(True)}, ("u",)).select("session_start", "session_end", "n", "u")
    assert rows(got) == [(at(0), at(1800), 2, "a"), (at(3601), at(3601), 1, "b")]


def test_sessions_equal_event_by_event_definition(spark):
    picks = random.Random(3)
    events = [(picks.choice("ab"), picks.randrange(0, 60_000)) for _ in range(120)]
    df = spark.createDataFrame([(k, at(s)) for k, s in events], "k string, t timestamp")
    got = rows(sessions_by_gap(df, "k", "t", 10, {"n": F.lit(True)}, ()).select("k", "session_start", "session_end", "n"))
    want = []
    for name in "ab":
        times = sorted(s for k, s in events if k == name)
        run = [times[0]]
        for s in times[1:]:
            if s - run[-1] > 600:
                want.append((name, at(run[0]), at(run[-1]), len(run)))
                run = []
            run.append(s)
        want.append((name, at(run[0]), at(run[-1]), len(run)))
    assert got == sorted(want, key=str)


def test_bots_exceed_the_rate_within_one_minute(spark):
    df = spark.createDataFrame(
        [("u", at(0)), ("u", at(1)), ("u", at(2)), ("u", at(70)), (None, at(0)), (None, at(1)), (None, at(2))],
        "user string, t timestamp")
    flagged = flag_bots(df, "user", "t", 2).where("is_bot")
    assert rows(flagged.select("user", "t")) == [("u", at(0)), ("u", at(1)), ("u", at(2))]


# --- identity ---------------------------------------------------------------

def test_clusters_equal_union_find(spark):
    picks = random.Random(11)
    data = [(f"r{i:03d}", picks.choice([None, *range(40)]), picks.choice([None, *range(40)])) for i in range(90)]
    chain = [(f"z{i:03d}", 1000 + i // 2, 2000 + (i + 1) // 2) for i in range(40)]  # one long path
    parent = {r: r for r, _, _ in data + chain}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for position in (1, 2):
        first = {}
        for record in data + chain:
            if record[position] is None:
                continue
            other = first.setdefault(record[position], record[0])
            a, b = sorted((find(record[0]), find(other)))
            parent[b] = a
    df = spark.createDataFrame(data + chain, "id string, phone int, email int")
    got = identity_clusters(df, "id", {"phone": "phone", "email": "email"})
    assert {r["id"]: r["person_id"] for r in got.collect()} == {r: find(r) for r in parent}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def typo(text, picks, edits):
    for _ in range(edits):
        place = picks.randrange(len(text))
        kind = picks.randrange(3)
        text = text[:place] + ("" if kind == 0 else picks.choice("abz")) + text[place + (kind != 1):]
    return text


@pytest.mark.parametrize("size", [6, 12, 19, 29, 34, 47])
def test_fuzzy_match_finds_what_comparing_all_pairs_finds(spark, size):
    picks = random.Random(size)
    names = ["".join(picks.choice("abcdefgh ") for _ in range(size)) for _ in range(4)]
    left = [(f"a{i}", "p", n) for i, n in enumerate(names)] + [("a9", "q", names[0]), ("n", None, names[0])]
    right = [(f"b{i:02d}", "p", typo(picks.choice(names), picks, picks.randrange(0, 6))) for i in range(24)]
    want = []
    for a, block, x in left:
        best = [(-(1 - edit_distance(x, y) / max(len(x), len(y))), b) for b, other, y in right
                if block == other and (max(len(x), len(y)) - edit_distance(x, y)) * 100 > 90 * max(len(x), len(y))]
        if best:
            want.append((a, min(best)[1]))
    schema = "{0} string, phone string, name string"
    got = fuzzy_match(spark.createDataFrame(left, schema.format("aid")), spark.createDataFrame(right, schema.format("bid")),
                      "phone", "name", "aid", "bid")
    assert rows(got.select("aid", "bid")) == sorted(want)


# --- settlements ------------------------------------------------------------

def test_settlement_keeps_both_unmatched_sides(spark):
    orders = spark.createDataFrame([("o1", at(0)), ("o2", at(0)), ("o3", at(0))], "order_id string, ordered_at timestamp")
    payments = spark.createDataFrame(
        [("p1", "o1", at(86400)), ("p2", "o1", at(5)), ("p3", "o2", at(86401)), ("p4", None, at(0)), ("p5", "zz", at(0))],
        "payment_id string, order_ref string, paid_at timestamp")
    got = joins.match_settlements(orders, payments, "1 day").select("order_id", "payment_id", "match_status")
    assert rows(got) == sorted([
        ("o1", "p1", "matched"), ("o1", "p2", "matched"), (None, "p3", "unmatched_payment"),
        (None, "p4", "unmatched_payment"), (None, "p5", "unmatched_payment"),
        ("o2", None, "unpaid_order"), ("o3", None, "unpaid_order")], key=str)


# --- changes ----------------------------------------------------------------

def test_cdc_applies_newest_and_drops_deletes(spark):
    rows_in = [("a", 1, "c", 10), ("a", 3, "u", 30), ("a", 2, "u", 20), ("b", 1, "c", 1), ("b", 2, "d", None)]
    image = F.struct("k", "v")
    df = spark.createDataFrame(rows_in, "k string, seq int, op string, v int").select(
        F.when(F.col("op") != "c", image).alias("before"), F.when(F.col("op") != "d", image).alias("after"), "op", "seq")
    assert rows(apply_cdc(df, "k", "seq")) == [("a", 30)]


def test_merge_keeps_newest_of_both(spark):
    schema = "k string, v int, t int"
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 5)], schema)
    new = spark.createDataFrame([("a", 9, 2), ("b", 9, 4), ("c", 3, 1)], schema)
    assert rows(merge_by_key(old, new, ["k"], "t", [])) == [("a", 9, 2), ("b", 2, 5), ("c", 3, 1)]


def test_high_water_mark(spark):
    target = spark.createDataFrame([("a", at(5)), ("b", at(9))], "k string, t timestamp")
    updates = spark.createDataFrame([("a", at(9)), ("c", at(10))], "k string, t timestamp")
    assert rows(above_high_water(updates, target, "t").select("k")) == [("c",)]
    assert above_high_water(updates, target.limit(0), "t").count() == 2


def test_summing_recomputes_means(spark):
    df = spark.createDataFrame([("w", 2, 10.0, 5.0), ("w", 1, 2.0, 2.0)], "k string, n bigint, total double, mean double")
    assert rows(summing_read(df, ["k"], ["n", "total"], {"mean": ("total", "n")})) == [("w", 3, 12.0, 4.0)]


def test_retention_and_masking(spark):
    df = spark.createDataFrame([("0912345678", "a@b.c", at(0)), ("12", "x@y.z", at(-8 * 86400))], "p string, e string, t timestamp")
    kept = retain(df, "t", 7, F.lit(at(0)))
    masked = mask(kept, {"p": "tail", "e": "email", "t": "drop"})
    assert rows(masked) == [("*******678", "***@b.c")]
    assert rows(mask(df.select("p"), {"p": "tail"})) == [("*******678",), ("12",)]


def test_orphans_ignore_null_keys(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    dim = spark.createDataFrame([(1,)], "pk int")
    assert rows(joins.orphans(fact, "fk", dim, "pk")) == [(2,)]
