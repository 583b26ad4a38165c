"""Operator 13: repair the structure of conversations by weighted interval parsing.

A row may be kept (cost 0), given the role user or assistant (1) or deleted (2, required for blank and duplicate rows); user and
assistant rows without text may be inserted anywhere (5); a truncated row that is not deleted costs 5 more. The cheapest edits
whose role initials form ``(s?(ua)+)?`` are taken, ties by the ASCII-least string of their initials (D, I, K, R).

- Grammar. A nonterminal (p, q) derives the rows of a span that lead from ``p`` to ``q``, where the four marks are: nothing yet,
  after s, after u, after a. It is in Chomsky normal form: ``RULES`` are (p, q) -> (p, r) (r, q), a single row has its own cells.
- Cells hold the least (cost, audit) of their nonterminal. ``INSERTED`` are the cells of an empty span, the closure under
  insertion; a row's cells are closed with them on both sides. Spans are combined bottom-up by length. Because the language is
  regular, every cut of a span gives the same cells, so one cut per span is enough: spans of 1, 2, 4, ... rows, n - 1 in all
  (the tests hold this against the table with every span and cut). No audit of a cell is a proper prefix of another one of its
  cost, so least audits stay least when joined.
- Distribution. Equal rows of a turn are counted, not repeated. Rows are dealt in ranges of (conversation, turn, role, text), so a
  conversation with a third of all rows is parsed by many tasks, each giving the cells of its part; the parts are joined by one
  small row each. A task holds the texts of at most one conversation's rows in its range; texts of conversations at the edge of
  a range are hashed afterwards, row by row. Only the audit itself, one letter a row, is as long as its conversation.

Defined cases: null role or text is one space, as is a null id or turn where the damage is drawn. Rows of one turn go by role and
then text. A null conversation id is a conversation of its own. A role without an initial s, u or a cannot be kept. Repeated rows
are duplicates. No rows left: zeros, empty audit, hash of the empty string. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SPACE_CHARS, stored, table

Cells = dict[tuple[int, int], tuple[int, str]]

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (NOTHING, ASSISTANT)
#: Where a role initial leads.
STEPS = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Role that a new or changed row gets at a mark.
NEXT_ROLE = {NOTHING: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Adjacent initials that are legal.
LEGAL = {"su", "ua", "au"}


def _closure() -> Cells:
    """Cells of an empty span: the cheapest insertions from one mark to another."""
    cells: Cells = {(p, p): (0, "") for p in range(4)}
    for _ in range(4):
        for (p, q), (cost, audit) in list(cells.items()):
            new = (p, STEPS[q, NEXT_ROLE[q][0]])
            cells[new] = min(cells.get(new, (1 << 60, "")), (cost + INSERT, audit + "I"))
    return cells


INSERTED = _closure()
#: (p, q) -> (p, r) (r, q)
RULES = [(p, r, q) for (p, r) in INSERTED for (r_, q) in INSERTED if r == r_]
RULES += [x for x in [(NOTHING, SYSTEM, q) for q in (SYSTEM, USER, ASSISTANT)] + [(NOTHING, NOTHING, SYSTEM)] if x not in RULES]


def join(left: Cells, right: Cells) -> Cells:
    """The cells of two neighbouring spans together."""
    out: Cells = {}
    for p, r, q in RULES:
        a, b = left.get((p, r)), right.get((r, q))
        if a and b:
            found = (a[0] + b[0], a[1] + b[1])
            if (p, q) not in out or found < out[p, q]:
                out[p, q] = found
    return out


def row_cells(initial: str, forced: bool, truncated: bool) -> Cells:
    """The cells of one row, closed under insertion before and after it."""
    cells: Cells = {(p, p): (DELETE, "D") for p in range(4)}
    if not forced:
        late = TRUNCATED if truncated else 0
        for p in range(4):
            for letter, cost, role in (("K", KEEP, initial), ("R", REROLE, "u"), ("R", REROLE, "a")):
                q = STEPS.get((p, role))
                if q is not None:
                    cells[p, q] = min(cells.get((p, q), (1 << 60, "")), (cost + late, letter))
    return join(join(INSERTED, cells), INSERTED)


ROW_CELLS = {(i, f, t): row_cells(i, f, t) for i in ("s", "u", "a", "") for f in (False, True) for t in (False, True)}


def copies_cells(n: int) -> Cells:
    """``n`` rows that must go: deletions sort before insertions."""
    return {k: (cost + DELETE * n, "D" * n + audit) for k, (cost, audit) in INSERTED.items()}


class Spans:
    """Cells of a growing row of spans. Equal lengths are joined as soon as they meet, so a logarithm of them is held."""

    def __init__(self) -> None:
        self.held: list[tuple[int, Cells]] = []

    def add(self, cells: Cells, length: int = 1) -> None:
        self.held.append((length, cells))
        while len(self.held) > 1 and self.held[-1][0] >= self.held[-2][0]:
            (b, right), (a, left) = self.held.pop(), self.held.pop()
            self.held.append((a + b, join(left, right)))

    def all(self) -> Cells:
        out = INSERTED
        for _, cells in reversed(self.held):
            out = join(cells, out)
        return out


def best(cells: Cells) -> tuple[int, str]:
    """Cost and audit of the cheapest edits that give a legal conversation."""
    return min(cells[NOTHING, q] for q in ENDS if (NOTHING, q) in cells)


def repaired(audit: Iterable[str], rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Apply the edits to the rows; the marks name the roles of new and changed rows."""
    at = NOTHING
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter in "IR":
            role = NEXT_ROLE[at]
        at = STEPS[at, role[:1]]
        yield role, text


def digest(rows: Iterable[tuple[str, str]]) -> str:
    found, first = hashlib.sha256(), True
    for role, text in rows:
        found.update(f"{'' if first else chr(10)}{role}:{text}".encode())
        first = False
    return found.hexdigest()


class Part:
    """Facts about neighbouring rows of one conversation, and their cells."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.rows = 0
        self.first = self.last = ""
        self.low = self.high = None
        self.spans = Spans()

    def add(self, turn, role: str, text: str, copies: int, seen: bool) -> None:
        if copies == 0:
            return
        text = text.rstrip(SPACE_CHARS)
        blank, late = text == "", text[-1:] not in ".!?"
        forced = blank or seen
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else copies if seen else copies - 1
        self.truncated += late and not forced
        pairs = copies - 1
        if pairs and role[:1] * 2 not in LEGAL:
            self.illegal += pairs
        if self.rows and self.last + role[:1] not in LEGAL:
            self.illegal += 1
        self.first, self.last = self.first if self.rows else role[:1], role[:1]
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.spans.add(ROW_CELLS[role[:1] if role[:1] in ("s", "u", "a") else "", forced, late])
        if pairs:
            self.spans.add(copies_cells(pairs), pairs)
        self.rows += copies

    def result(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, audit = best(self.spans.all())
        counts = {k: int(getattr(self, k)) for k in ("blank", "duplicate", "truncated", "illegal")}
        return {"gaps": gaps, **counts, "cost": cost, "audit": audit}

    def row(self) -> dict:
        """As a row that ``joined`` reads."""
        cells = sorted((p * 4 + q, cost, audit) for (p, q), (cost, audit) in self.spans.all().items())
        names = ("blank", "duplicate", "truncated", "illegal", "turns", "rows", "first", "last", "low", "high")
        return {**{k: getattr(self, k) for k in names}, "truncated": int(self.truncated), "symbols": [c[0] for c in cells], "costs": [c[1] for c in cells], "audits": [c[2] for c in cells]}


def joined(rows: Iterable[dict]) -> Part:
    """One part from the rows of neighbouring parts, in their order."""
    out = Part()
    for row in rows:
        if not row["rows"]:
            continue
        for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(out, k, getattr(out, k) + row[k])
        if out.rows and out.last + row["first"] not in LEGAL:
            out.illegal += 1
        out.first, out.last = out.first if out.rows else row["first"], row["last"]
        if row["low"] is not None:
            out.turns -= row["low"] == out.high
            out.low, out.high = row["low"] if out.low is None else out.low, row["high"]
        cells = {divmod(s, 4): (c, a) for s, c, a in zip(row["symbols"], row["costs"], row["audits"])}
        out.spans.add(cells, row["rows"])
        out.rows += row["rows"]
    return out


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
FINISHED, PART, ROW = range(3)
#: What a range of rows gives: finished conversations, parts of those at its edges, and the rows of those.
RANGE = RESULT + (
    ", kind int, part int, place long, role string, text string, copies long, turns long, rows long, first string, last string,"
    " low long, high long, symbols array<int>, costs array<long>, audits array<string>"
)
BATCH_ROWS = 5_000


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    some: list[dict] = []
    for row in rows:
        some.append(row)
        if len(some) == BATCH_ROWS:
            yield pa.RecordBatch.from_pylist(some, schema)
            some = []
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies) with the stated damage; dropped rows have no copies and keep their conversation listed."""

    def spaced(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(" "))

    draw = F.crc32(F.concat(spaced(rows[conv_id]), F.lit(":"), spaced(rows[turn])).cast("binary")) % 20
    drawn = rows.select(
        rows[conv_id].alias("conv"), rows[turn].cast("long").alias("turn"), spaced(rows[role]).alias("role"), spaced(rows[text]).alias("text"), draw.alias("draw")
    )
    gone = F.col("draw") == 0
    changed = F.when(gone | (F.col("draw") == 1), "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return drawn.select(
        "conv",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        changed.alias("text"),
        F.when(gone, 0).when(F.col("draw") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _parsed(conv: T.DataType):
    schema = _arrow(T.StructType([T.StructField("conv", conv), *T._parse_datatype_string(RANGE).fields]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def conversations() -> Iterator[tuple[bool, object, Part, list]]:
            """Whether it lies inside the range, the conversation, its facts and its rows."""
            now, facts, held, inside = None, None, [], False
            for conv, turn, role, text, copies, seen in _rows(batches):
                if facts is None or conv != now:
                    if facts is not None:
                        yield inside, now, facts, held
                        inside = True
                    now, facts, held = conv, Part(), []
                facts.add(turn, role, text, copies, seen)
                if copies:
                    held.append((role, text, copies))
            if facts is not None:
                yield False, now, facts, held

        def out() -> Iterator[dict]:
            for inside, conv, facts, held in conversations():
                if inside:
                    found = facts.result()
                    each = ((role, text) for role, text, n in held for _ in range(n))
                    yield {"conv": conv, "kind": FINISHED, **found, "repaired_sha256": digest(repaired(found["audit"], each))}
                else:
                    yield {"conv": conv, "kind": PART, "part": part, **facts.row()}
                    for place, (role, text, copies) in enumerate(held):
                        yield {"conv": conv, "kind": ROW, "part": part, "place": place, "role": role, "text": text, "copies": copies}

        yield from _batches(out(), schema)

    return run


def _hashed(conv: T.DataType):
    """Rows in order, each conversation led by its result: the hash is brought forward row by row."""
    schema = _arrow(T.StructType([T.StructField("conv", conv), *T._parse_datatype_string(RESULT).fields]))
    names = [f.name for f in schema][1:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _rows(batches)

        def out() -> Iterator[dict]:
            head = next(rows, None)
            while head is not None:
                after: list = [None]

                def own() -> Iterator[tuple[str, str]]:
                    for row in rows:
                        if row[1] == FINISHED:
                            after[0] = row
                            return
                        for _ in range(row[4]):
                            yield row[2], row[3]

                found = dict(zip(names, head[5:]))
                each = own()
                result = digest(repaired(found["audit"], each))
                for _ in each:
                    raise ValueError("an audit is shorter than its conversation")
                yield {"conv": head[0], **found, "repaired_sha256": result}
                head = after[0]

        yield from _batches(out(), schema)

    return run


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv, turn, role, text, copies): its faults, the cheapest edits and their hash."""
    conv = rows.schema["conv"].dataType
    name = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    facts = rows.filter("copies > 0").select("conv", F.struct("turn").alias("turn"), F.unhex(name).alias("own"))
    again = facts.groupBy("conv", "own").agg(F.min("turn").alias("least"), F.max("turn").alias("most")).filter("least != most").drop("most")
    single = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("own", F.unhex(name))
    same = single["conv"].eqNullSafe(again["conv"]) & (single["own"] == again["own"])
    marked = single.join(again, same, "left").select(
        single["conv"], "turn", "role", "text", "copies", F.coalesce(F.struct("turn") > F.col("least"), F.lit(False)).alias("seen")
    )
    keys = ("conv", "turn", "role", "text")
    dealt = marked.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = T.StructType([T.StructField("conv", conv), *T._parse_datatype_string(RANGE).fields])
    found = stored(dealt.mapInArrow(_parsed(conv), schema), "conversations")

    results = [f.name for f in T._parse_datatype_string(RESULT).fields]
    parts = found.filter(F.col("kind") == PART).select("conv", "part", "blank", "duplicate", "truncated", "illegal", "turns", "rows", "first", "last", "low", "high", "symbols", "costs", "audits")

    def join_parts(key: tuple, table_: pa.Table) -> pa.Table:
        rows_ = sorted(table_.to_pylist(), key=lambda r: r["part"])  # one for each range at most
        return pa.Table.from_pylist([{"conv": rows_[0]["conv"], **joined(rows_).result(), "repaired_sha256": None}], ends)

    ends = _arrow(T.StructType([T.StructField("conv", conv), *T._parse_datatype_string(RESULT).fields]))
    heads = parts.groupBy("conv").applyInArrow(join_parts, T.StructType([schema["conv"], *T._parse_datatype_string(RESULT).fields]))
    columns = ["conv", "kind", "role", "text", "copies", *results[:-1]]
    lead = heads.withColumns({"kind": F.lit(FINISHED), "part": F.lit(-1), "place": F.lit(0).cast("long"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "copies": F.lit(0).cast("long")})
    order = ("conv", "kind", "part", "place")
    rest = found.filter(F.col("kind") == ROW).select(*columns, "part", "place").unionByName(lead.select(*columns, "part", "place"))
    late = rest.repartition("conv").sortWithinPartitions(*order).select(columns).mapInArrow(_hashed(conv), T.StructType([schema["conv"], *T._parse_datatype_string(RESULT).fields]))
    return found.filter(F.col("kind") == FINISHED).select("conv", *results).unionByName(late)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")
