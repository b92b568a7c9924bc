"""Spelling variants by permuterm rotations.

A word is marked with a terminator and rotated: the rotation that starts behind position ``i`` of ``x c y`` is ``y $ x c``.
Without its last character it is the prefix ``y $ x`` that every word sharing ``x`` and ``y`` around one other character has
(a replacement), and the word ``x y`` has as a whole rotation (an indel). So the rotations are put in order by that
prefix, and each range of one prefix holds exactly the words one edit apart there. A range has at most one member for each
character of the alphabet and one whole rotation, whatever the corpus.
"""

from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import map_batches
from martloom.session import write_once

LEAST_LETTERS = 6
LEAST_COUNT = 5
TIMES = 5  # a form is at least so many times as frequent
DROPPED = 199
TERMINATOR = "$"
# Words beyond are rotated as running hashes: their rotations would hold the square of their length.
LONG = 64
PRIMES = ((1 << 61) - 1, (1 << 89) - 1)
BASE = 1_000_003
HELD = 200_000  # distinct words a task counts before it hands them on

# Latin-1 bytes: A-Z become a-z, other letters of the range stay, the rest ends a run.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ``[A-Za-z\\u00C0-\\u00FF]`` as Latin-1 bytes; every other character is a gap."""
    return text.encode("latin-1", "replace").translate(LETTERS).split() if text else []


def misspelt(run: bytes, prefix: int) -> bytes:
    """The run, without one character where the checksum of id and run says so; ``prefix`` is the checksum of ``<doc_id>:``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % DROPPED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of every word long and frequent enough. A null id counts as the empty text."""

    def make():
        held: Counter = Counter()

        def hand_on():
            out = {"word": [w.decode("latin-1") for w in held], "n": list(held.values())}
            held.clear()
            return out

        def step(ids, texts):
            for doc_id, text in zip(ids, texts):
                prefix = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
                for run, n in Counter(runs_of(text)).items():
                    # A shorter run can be no word, whatever is dropped from it.
                    if len(run) >= letters:
                        word = misspelt(run, prefix)
                        if len(word) >= letters:
                            held[word] += n
            return hand_on() if len(held) > HELD else None

        step.finish = hand_on
        return step

    counted = map_batches(docs, ["doc_id", "text"], "word string, n bigint", make)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _hashes(word: str):
    """Running hashes of a marked word, and a function from a piece ``[i, j)`` of its double to a hash pair."""
    marked = word + TERMINATOR
    sums, powers = [(0, 0)], [(1, 1)]
    for c in marked * 2:
        sums.append(tuple((s * BASE + ord(c)) % p for s, p in zip(sums[-1], PRIMES)))
        powers.append(tuple(w * BASE % p for w, p in zip(powers[-1], PRIMES)))
    return lambda i, j: tuple((sums[j][k] - sums[i][k] * powers[j - i][k]) % p for k, p in enumerate(PRIMES))


def name_of(word: str) -> str:
    """What stands for a word in the rotations: itself, or a name made of its hashes where it is long."""
    return word if len(word) <= LONG else "#%d:%x:%x" % (len(word), *_hashes(word)(0, len(word)))


def rotations(word: str) -> list[tuple[str, str, bool]]:
    """``(prefix, skipped character, last of its repeats)``; nothing is skipped in a whole rotation.

    Removing any of several equal neighbours gives the same word; only the last of them counts for indels.
    """
    n = len(word)
    double = (word + TERMINATOR) * 2
    hashes = _hashes(word) if n >= LONG else None

    def prefix(i: int, length: int) -> str:
        return double[i:i + length] if length <= LONG else "#%d:%x:%x" % (length, *hashes(i, i + length))

    out = [(prefix(i, n + 1), "", False) for i in range(n + 1)]
    return out + [(prefix(i + 1, n), word[i], i + 1 == n or word[i + 1] != word[i]) for i in range(n)]


def _rotated(words: DataFrame) -> DataFrame:
    def make():
        def step(names, texts):
            out = {"prefix": [], "skipped": [], "closing": [], "name": []}
            for name, word in zip(names, texts):
                for prefix, skipped, closing in rotations(word):
                    out["prefix"].append(prefix)
                    out["skipped"].append(skipped)
                    out["closing"].append(closing)
                    out["name"].append(name)
            return out
        return step

    return map_batches(words, ["name", "word"], "prefix string, skipped string, closing boolean, name string", make)


def _scan():
    """A task's step over rotations in order: emits the neighbours of each range; the last range waits for the next batch."""
    held: list[tuple] = []

    def neighbours(group, out):
        whole = [name for skipped, _, name in group if not skipped]
        for skipped, closing, name in group:
            if not skipped:
                continue
            near = [other for c, _, other in group if c and c != skipped]
            out["name"] += [name] * len(near)
            out["near"] += near
            if closing:
                for other in whole:
                    out["name"] += [name, other]
                    out["near"] += [other, name]

    def step(prefixes, skipped, closing, names):
        out = {"name": [], "near": []}
        for prefix, *member in zip(prefixes, skipped, closing, names):
            if held and held[0][0] != prefix:
                if len(held) > 1:
                    neighbours([m for _, m in held], out)
                held.clear()
            held.append((prefix, member))
        return out

    def finish():
        out = {"name": [], "near": []}
        if len(held) > 1:
            neighbours([m for _, m in held], out)
        return out

    step.finish = finish
    return step


def neighbours(words: DataFrame) -> DataFrame:
    """``name, near``: every ordered pair of distinct words one edit apart, once, by their names.

    ``words`` has ``word`` and its ``name``. Rotations of one prefix meet in one task because the range partitions are cut
    between prefixes; a prefix has at most 91 members, and a word at most 181 pairs for each of its positions.
    """
    ordered = _rotated(words).repartitionByRange("prefix").sortWithinPartitions("prefix")
    return map_batches(ordered, ["prefix", "skipped", "closing", "name"], "name string, near string", _scan)


def spelling_variants(docs: DataFrame, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the documents.

    A null or empty text has no words; a null id counts as the empty text; repeated rows count each time. No words give no rows.
    Only doc_id and text are read.
    """
    def make():
        return lambda texts, n: {"name": [name_of(w) for w in texts], "word": texts, "n": n}

    named = map_batches(word_counts(docs, letters, least), ["word", "n"], "name string, word string, n bigint", make)
    words = write_once(named, "words")
    near = words.select(F.col("name").alias("near"), F.col("word").alias("near_word"), F.col("n").alias("near_count"))
    # Least by (-n, word): the most frequent neighbour, and of those the first in code-point order.
    met = neighbours(words).join(near, "near").groupBy("name").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_count")).alias("minus"), F.col("near_word").alias("near"))).alias("top"))
    joined = words.join(met, "name", "left")
    frequent = -F.col("top.minus") >= F.col("n") * times
    formed = write_once(joined.select(
        "word", F.when(frequent, F.col("top.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(frequent, -F.col("top.minus")).alias("form_n")), "forms")
    return formed.join(roots(formed), "word").select("word", "form", "root", "n", "n_near", "form_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last word that following the forms leads to.

    Every round doubles the steps followed. A form is several times as frequent as its word, so chains are
    short: the rounds grow with the logarithm of the logarithm of the largest count.
    """
    led = write_once(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        further = led.where("root <> word").select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        joined = led.join(further, led.root == further.via, "left")
        if joined.where("beyond IS NOT NULL").isEmpty():
            return led
        led = write_once(joined.select("word", F.coalesce("beyond", "root").alias("root")), "roots")
