"""Behaviour paths: each user's steps in order, with equal neighbours counted once.

One user may own a large part of all rows, so no user is sorted in one task. Rows are dealt in ranges of (user, time, tie), which
cut a busy user and even a busy second at any place. A task walks its range once and gives one short row per user in it, the
digest of that piece of the path. Digests of neighbouring pieces join to the digest of both, without the rows: a step that ends
one piece and begins the next is dropped at the joint. One digest per user is left, and equal digests are equal paths.

A digest is: the number of steps, the first and the last step, and for each of three primes the value of the path as a polynomial
with the power that shifts it (93 bits beside the length) and the number of its first step. The steps are read a second time for the paths that are shown.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARROW = " → "
PRIMES = (2147483647, 2147483629, 2147483587)
BASES = (1948305433, 1021984613, 1734519797)
# of the hash of a step, one for each prime
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_HASHES, _POWERS, _LETTERS = ([f"_{x}{n}" for n in range(3)] for x in "hpl")
NUMBERS = [*_HASHES, *_POWERS, *_LETTERS]
DIGEST = ["_steps", "_first", "_last", *NUMBERS]
#: Orders the pieces of a user.
PIECE = "_piece"

def _letters(steps: pa.Array) -> np.ndarray:
    """A number below each prime per step, by its text: rows of primes, columns of steps."""
    coded = steps.dictionary_encode()
    table = np.empty((3, len(coded.dictionary)), dtype=np.uint64)
    for n, text in enumerate(coded.dictionary.to_pylist()):
        for k, seed in enumerate(_SEEDS):
            value = seed
            for byte in text.encode():
                value = ((value ^ byte) * 0x100000001B3 + seed) % (1 << 64)
            table[k, n] = (value ^ (value >> 29)) % (PRIMES[k] - 1) + 1
    return table[:, coded.indices.to_numpy()]


def _powers(n: int) -> np.ndarray:
    """Powers 0..n of the bases modulo the primes."""
    out = np.ones((3, n + 1), dtype=np.uint64)
    known = 1
    while known <= n:
        more = min(known, n + 1 - known)
        for k in range(3):
            next_ = out[k, known - 1] * np.uint64(BASES[k]) % np.uint64(PRIMES[k])
            out[k, known : known + more] = out[k, :more] * next_ % np.uint64(PRIMES[k])
        known += more
    return out


def _values(letters: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial values of runs of letters, and the powers that shift something before them."""
    powers = _powers(int(size.max(initial=0)))
    left = np.repeat(size, size) - np.arange(int(size.sum())) + np.repeat(np.cumsum(size) - size, size) - 1
    out = np.empty((3, len(size)), dtype=np.uint64)
    for k, prime in enumerate(PRIMES):
        terms = letters[k] * powers[k][left] % np.uint64(prime)
        out[k] = np.add.reduceat(terms, begin) % np.uint64(prime)  # up to 2**33 terms of 31 bits
    return out, powers[:, size]


def _pieces(user: str, user_type: T.DataType, with_steps: bool):
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(user_type)
    names = [user, PIECE, "_steps", "_first", "_last", *(["_walked"] if with_steps else NUMBERS)]

    def batch_of(columns: list[pa.Array], from_: int = 0, to: int | None = None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(columns, names).slice(from_, None if to is None else to - from_)

    def found_in(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        """The pieces of each batch; a step that the batch before ended with is not counted again."""
        number, part = 0, TaskContext.get().partitionId()
        last_user = last_step = None
        for batch in batches:
            users, steps = batch.column(0).cast(kind), batch.column(1).cast(pa.string())
            if not len(users):
                continue
            before_u = pa.concat_arrays([pa.array([last_user], kind), users[:-1]])
            before_s = pa.concat_arrays([pa.array([last_step], pa.string()), steps[:-1]])
            new = pc.fill_null(pc.not_equal(users, before_u), True).to_numpy(zero_copy_only=False)
            moved = pc.fill_null(pc.not_equal(steps, before_s), True).to_numpy(zero_copy_only=False)
            last_user, last_step = users[-1].as_py(), steps[-1].as_py()
            kept = np.flatnonzero(new | moved)
            if not len(kept):
                continue
            own, walked = users.take(pa.array(kept)), steps.take(pa.array(kept))
            begin = np.flatnonzero(new[kept] | (np.arange(len(kept)) == 0))
            size = np.diff(np.concatenate([begin, [len(kept)]]))
            columns = [own.take(pa.array(begin)), pa.array((np.int64(part) << 33) + number + np.arange(len(begin))), pa.array(size)]
            number += len(begin)
            columns += [walked.take(pa.array(begin)), walked.take(pa.array(begin + size - 1))]
            if with_steps:
                columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([begin, [len(kept)]]), pa.int32()), walked))
            else:
                letters = _letters(walked)
                values, powers = _values(letters, begin, size)
                columns += [pa.array(x.astype(np.int64)) for x in (*values, *powers, *letters[:, begin])]
            yield columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None  # the piece of the user that the last batch ended with: the next may go on with it
        for columns in found_in(batches):
            if with_steps:
                yield batch_of(columns)
                continue
            first, n = [c[0].as_py() for c in columns], len(columns[0])
            if held is not None and held[0] == first[0]:
                first = _follow(held, first)
            elif held is not None:
                yield batch_of([pa.array([x], c.type) for x, c in zip(held, columns)])
            if n > 1:
                yield batch_of([pa.array([x], c.type) for x, c in zip(first, columns)])
                yield batch_of(columns, 1, n - 1)
                held = [c[-1].as_py() for c in columns]
            else:
                held = first
            types = [c.type for c in columns]
        if held is not None:
            yield batch_of([pa.array([x], t) for x, t in zip(held, types)])

    return run


def _follow(left: list, right: list) -> list:
    """The piece of two that follow each other in one task, where the joint has been looked at already."""
    user, piece, steps, first, _, *numbers = left
    more, last, others = right[2], right[4], right[5:]
    out = [user, piece, steps + more, first, last]
    out += [(numbers[k] * others[3 + k] + others[k]) % PRIMES[k] for k in range(3)]
    out += [numbers[3 + k] * others[3 + k] % PRIMES[k] for k in range(3)]
    return out + numbers[6:]


def path_pieces(df: DataFrame, user: str, step: str, ts: str, tie: list[str], with_steps: bool = False) -> DataFrame:
    """``user, _piece`` and the digest of each piece, or its steps. Order is event time, then ``tie``; rows without a step are left out."""
    rows = df.filter(F.col(user).isNotNull() & F.col(ts).isNotNull() & F.col(step).isNotNull())
    ties = {f"_tie{n}": F.col(c) for n, c in enumerate(tie)}
    rows = rows.select(F.col(user).alias("_user"), F.col(step).cast("string").alias("_step"), F.col(ts).alias("_ts"), *(c.alias(n) for n, c in ties.items()))
    order = ["_user", "_ts", *ties, "_step"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_user", "_step")
    kind = df.schema[user].dataType
    more = "_walked array<string>" if with_steps else ", ".join(f"{c} long" for c in NUMBERS)
    fields = T._parse_datatype_string(f"{PIECE} long, _steps long, _first string, _last string, {more}").fields
    return dealt.mapInArrow(_pieces(user, kind, with_steps), T.StructType([T.StructField(user, kind), *fields]))


def _times(a: Column, b: Column, k: int) -> Column:
    return a * b % F.lit(PRIMES[k]).cast("bigint")


def joined(left: Column, right: Column) -> Column:
    """The digest of two neighbouring pieces. Where the right one begins as the left one ends, its first step is dropped: its value
    loses that step's term, and its power one factor."""
    repeat = left["_last"] == right["_first"]
    out = [left["_steps"] + right["_steps"] - repeat.cast("bigint"), left["_first"], right["_last"]]
    shifts = [F.when(repeat, _times(right[p], F.lit(pow(b, -1, q)).cast("bigint"), k)).otherwise(right[p]) for k, (p, b, q) in enumerate(zip(_POWERS, BASES, PRIMES))]
    for k, (h, letter) in enumerate(zip(_HASHES, _LETTERS)):
        dropped = F.when(repeat, _times(right[letter], shifts[k], k)).otherwise(F.lit(0).cast("bigint"))
        out.append((_times(left[h], shifts[k], k) + right[h] - dropped + PRIMES[k]) % F.lit(PRIMES[k]).cast("bigint"))
    out += [_times(left[p], shifts[k], k) for k, p in enumerate(_POWERS)]
    out += [left[letter] for letter in _LETTERS]
    return F.struct(*(c.alias(n) for c, n in zip(out, DIGEST)))


def user_digests(pieces: DataFrame, user: str, *order: str) -> DataFrame:
    """One digest per user from its pieces in ``order``: a few short rows each, one for every range or slice it appears in."""
    listed = F.array_sort(F.collect_list(F.struct(*order, F.struct(*DIGEST).alias("_digest"))))
    in_order = F.transform(listed, lambda x: x["_digest"])
    whole = F.aggregate(F.slice(F.col("_all"), 2, F.greatest(F.size("_all") - 1, F.lit(0))), F.get("_all", F.lit(0)), joined)
    return pieces.groupBy(user).agg(in_order.alias("_all")).select(user, whole.alias("_digest")).select(user, "_digest.*")


def common(digests: DataFrame, user: str, k: int, min_steps: int = 2) -> DataFrame:
    """``first_user, steps, users`` of the ``k`` paths walked by most users. Equal numbers go by fewer steps, then by the smallest user."""
    patterns = (
        digests.filter(F.col("_steps") >= min_steps)
        .groupBy("_steps", *_HASHES)
        .agg(F.count(F.lit(1)).alias("users"), F.min(user).alias("first_user"))
    )
    top = patterns.orderBy(F.desc("users"), F.asc("_steps"), F.asc("first_user")).limit(k)
    return top.select("first_user", F.col("_steps").alias("steps"), "users")


def written_out(shown: DataFrame, df: DataFrame, user: str, step: str, ts: str, tie: list[str]) -> DataFrame:
    """``path, steps, users, first_user``: the rows of the shown users are read again and cut to steps before a user's meet."""
    walkers = df.join(F.broadcast(shown.select(F.col("first_user").alias(user), "steps", "users")), user)  # k rows
    about = F.struct(F.col(user).alias("first_user"), "steps", "users")
    held = walkers.withColumn("_who", F.to_json(about))  # one text, to be told apart like a user
    kind = walkers.select(about.alias("x")).schema["x"].dataType
    pieces = path_pieces(held, "_who", step, ts, tie, with_steps=True)
    listed = F.array_sort(F.collect_list(F.struct(PIECE, "_walked")))
    steps = F.flatten(F.transform(listed, lambda x: x["_walked"]))
    # neighbours that are equal meet where two ranges do
    text = F.array_join(F.expr("filter(transform(_all, (s, i) -> if(i > 0 and s = _all[i - 1], null, s)), s -> s is not null)"), ARROW)
    whole = pieces.groupBy("_who").agg(steps.alias("_all")).withColumn("_who", F.from_json("_who", kind))
    return whole.select(text.alias("path"), "_who.steps", "_who.users", "_who.first_user")


def path_patterns(df: DataFrame, user: str, step: str, ts: str, tie: list[str], k: int = 5, min_steps: int = 2) -> DataFrame:
    """The ``k`` paths walked by most users: ``path, steps, users, first_user``; the smallest user of a path stands for it."""
    digests = user_digests(path_pieces(df, user, step, ts, tie), user, PIECE)
    return written_out(common(digests, user, k, min_steps), df, user, step, ts, tie)
