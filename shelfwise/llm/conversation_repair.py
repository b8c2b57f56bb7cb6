"""Conversation structure repair: weighted CYK parsing of a conversation's rows as intervals.

The repair grammar writes ``(s?(ua)+)?`` in Chomsky normal form.  A nonterminal ``pq`` stands for the edits that
lead from ``p`` to ``q``, where 0 is nothing written yet and s, u, a the role written last: ``pr -> pq qr`` for
every pair, and ``pq`` to one row by an edit.  The insertion closure adds empty-text rows before and after.  The cell
of a span holds for each nonterminal the least (cost, audit); of one cost no audit begins another, so least parts
make least wholes.  Spans are combined bottom-up by their length.  Every split of a span serves ``pr -> pq qr``
alike, since a repair passes some role there, so one split a span is enough: halves, and cells grow as 1, 2, 4...

A conversation is cut into blocks of ``BLOCK`` rows, each parsed by itself; cells of blocks are combined
``FAN`` at a time, level by level, so no task holds all rows of a long conversation.  Only the hash of the repaired
text reads a conversation's rows in order, as a stream.

Defined results: a null role or text is one space, in the key of the damage a null id or turn, too; null
turns come first and count in no gap; rows of one turn go by role and the SHA-256 of role and text; a null conv_id is
a conversation; an empty table gives no row; a very long text is one row's.  Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, materialise

#: Rows of a block, and cells that are combined at once.
BLOCK, FAN = 64, 16
#: Costs of the edits; a truncated row that stays adds ``TRUNCATED``.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: What may be written after each role (0: after nothing), what ends a repair, and full names of roles.
AFTER, ENDS, NAMES = {"0": "su", "s": "u", "u": "a", "a": "u"}, "0a", {"u": "user", "a": "assistant"}
PAIRS = [p + q for p in AFTER for q in AFTER]
# fixed values: white space of the contract, and characters that end a sentence
SPACE, SENTENCE_ENDS = "\\x20\\x09-\\x0D", "[.!?]"

CELL = T.StructType(
    [
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("illegal", T.LongType()),
        T.StructField("costs", T.ArrayType(T.LongType())),
        T.StructField("audits", T.ArrayType(T.StringType())),
    ]
)
Cell = dict[str, tuple[int, str]]


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults by the remainder of ``crc32(conv_id:turn)`` by 20."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")), F.lit(20))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", SENTENCE_ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    plain = rows.select("conv_id", "turn", or_space("role").alias("role"), or_space("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    copies = plain.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))))
    return copies.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def ordered(rows: DataFrame) -> DataFrame:
    """``rows`` in the shared folder with ``at``, their number in the order of conv_id and turn, and what faults
    are told by.

    The whole table is sorted by range, so that a conversation may lie in any number of tasks; equal rows
    are told apart by a number, which may split them.
    """
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest"), F.asc("_tie")]
    keyed = rows.withColumn("digest", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    keyed = keyed.withColumn("_tie", F.monotonically_increasing_id())
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
    seen = ranged.select(
        "*",
        F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(f"[^{SPACE}]")).alias("is_blank"),
        (~F.col("text").rlike(f"{SENTENCE_ENDS}[{SPACE}]*\\z")).alias("is_cut"),
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_id"),
    )
    # the places are written down with the rows: a second run of the exchange may cut elsewhere
    marked = materialise(seen, "ordered-turns")
    first = marked.groupBy("_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))  # a row for each partition
    starts = first.select("_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    return marked.join(starts, "_part").withColumn("at", F.col("_id") + F.col("_shift")).drop("_part", "_id", "_shift")


def with_faults(rows: DataFrame) -> DataFrame:
    """``conv_id, conv, at, block, turn, initial, fault``, without texts: ``conv`` is the first ``at`` of the
    conversation, ``fault`` the first of blank, duplicate and truncated, or none."""
    rows = rows.drop("role", "text")
    heads = rows.groupBy(F.col("conv_id").alias("_c")).agg(F.min("at").alias("conv"))
    rows = rows.join(heads, F.col("conv_id").eqNullSafe(F.col("_c"))).withColumn("block", F.floor((F.col("at") - F.col("conv")) / BLOCK))
    firsts = rows.groupBy("conv", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("_first"))
    fault = F.when(F.col("is_blank"), "blank").when(F.col("_first").isNull(), "duplicate").when(F.col("is_cut"), "truncated").otherwise("")
    return rows.join(firsts, "at", "left").select("conv_id", "conv", "at", "block", "turn", "initial", fault.alias("fault"))


def closed(cell: Cell) -> Cell:
    """The insertion closure: rows may be put in before and after what the cell spans."""
    return combined(combined(_INSERTED, cell), _INSERTED)


def combined(left: Cell, right: Cell) -> Cell:
    """``pr -> pq qr``: the least of every way over a split."""
    out: Cell = {}
    for pq, (cost, audit) in left.items():
        for r in AFTER:
            if (more := right.get(pq[1] + r)) is not None:
                found = (cost + more[0], audit + more[1])
                if (known := out.get(pq[0] + r)) is None or found < known:
                    out[pq[0] + r] = found
    return out


def _insertions() -> Cell:
    """Cells of the empty span: what rows put in lead from one role to another, at most two of use."""
    out: Cell = {p + p: (0, "") for p in AFTER}
    one = {p + q: (INSERT, "I") for p in AFTER for q in AFTER[p] if q in NAMES}
    return {**combined(one, one), **one, **out}


_INSERTED = _insertions()


def row_cell(initial: str, fault: str) -> Cell:
    """Edits of one row: keep it, give it another role, delete it."""
    out: Cell = {p + p: (DELETE, "D") for p in AFTER}
    if fault not in ("blank", "duplicate"):
        stays = TRUNCATED if fault == "truncated" else 0
        for p, roles in AFTER.items():
            for q in roles:
                if q == initial:
                    out[p + q] = (stays, "K")
                elif q in NAMES:
                    out[p + q] = (stays + REROLE, "R")
    return closed(out)


def by_length(cells: list[Cell]) -> Cell:
    """The cell of a whole span, from spans of 1, 2, 4... upwards."""
    while len(cells) > 1:
        pairs = [combined(x, y) for x, y in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(pairs) * 2 :]
    return cells[0]


def _pack(cell: Cell) -> dict[str, list]:
    found = [cell.get(p, (None, None)) for p in PAIRS]
    return {"costs": [c for c, _ in found], "audits": [a for _, a in found]}


def _unpack(row: dict) -> Cell:
    return {p: (c, a) for p, c, a in zip(PAIRS, row["costs"], row["audits"]) if c is not None}


def _illegal(before: str, after: str) -> bool:
    return before + after not in ("su", "ua", "au")


def block_cells(rows: DataFrame) -> DataFrame:
    """``conv, block, cell`` of every block of rows: at most ``BLOCK`` of them, without their texts."""
    schema = T.StructType([T.StructField("conv", T.LongType()), T.StructField("block", T.LongType()), *CELL])

    def make():
        leaves: dict[tuple[str, str], Cell] = {}

        def leaf(initial: str, fault: str) -> Cell:
            key = (initial if initial in ("s", "u", "a") else "", fault)
            if key not in leaves:
                leaves[key] = row_cell(*key)
            return leaves[key]

        def work(batch: pa.RecordBatch) -> dict[str, list]:
            out: dict[str, list] = {c: [] for c in schema.names}
            for row in batch.to_pylist():
                turns = sorted(row["turns"], key=lambda t: t["at"])
                initials = [t["initial"] for t in turns]
                cell = _pack(by_length([leaf(t["initial"], t["fault"]) for t in turns]))
                illegal = sum(map(_illegal, initials, initials[1:]))
                for c, v in {"conv": row["conv"], "block": row["block"], "first": initials[0], "last": initials[-1], "illegal": illegal, **cell}.items():
                    out[c].append(v)
            return out

        return work

    turn = F.struct("at", "initial", "fault")
    return arrow_rows(rows.groupBy("conv", "block").agg(F.collect_list(turn).alias("turns")), make, schema)


def conversation_cells(cells: DataFrame) -> DataFrame:
    """One cell a conversation: those of ``FAN`` neighbouring blocks are combined until one is left of each."""
    cells, names = materialise(cells, "block-cells"), cells.columns
    while (cells.agg(F.max("block")).first()[0] or 0) > 0:

        def make():
            def work(batch: pa.RecordBatch) -> dict[str, list]:
                out: dict[str, list] = {c: [] for c in names}
                for row in batch.to_pylist():
                    some = sorted(row["cells"], key=lambda c: c["block"])
                    between = sum(_illegal(x["last"], y["first"]) for x, y in zip(some, some[1:]))
                    cell = {"first": some[0]["first"], "last": some[-1]["last"], "illegal": between + sum(c["illegal"] for c in some)}
                    for c, v in {"conv": row["conv"], "block": row["wide"], **cell, **_pack(by_length(list(map(_unpack, some))))}.items():
                        out[c].append(v)
                return out

            return work

        wide = F.floor(F.col("block") / FAN).alias("wide")
        some = cells.groupBy("conv", wide).agg(F.collect_list(F.struct("block", *CELL.names)).alias("cells"))  # at most FAN
        cells = materialise(arrow_rows(some, make, cells.schema), "wider-cells")
    return cells


def _best(cell: Cell) -> tuple[int, str]:
    return min(cell["0" + q] for q in ENDS if "0" + q in cell)


def audits(cells: DataFrame) -> DataFrame:
    """``conv, illegal, cost, audit`` of conversations."""
    schema = T.StructType([T.StructField("conv", T.LongType()), T.StructField("illegal", T.LongType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, list]:
            rows = batch.to_pylist()
            best = [_best(_unpack(r)) for r in rows]
            return {"conv": [r["conv"] for r in rows], "illegal": [r["illegal"] for r in rows], "cost": [c for c, _ in best], "audit": [a for _, a in best]}

        return work

    return arrow_rows(cells, make, schema)


def edits_of_rows(found: DataFrame) -> DataFrame:
    """``conv, at, edits``: the part of the audit that falls to each row, with the insertions before it, and for
    the last row those after it."""
    schema = T.StructType([T.StructField("conv", T.LongType()), T.StructField("at", T.LongType()), T.StructField("edits", T.StringType())])

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, list]:
            out: dict[str, list] = {c: [] for c in schema.names}
            for conv, audit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = re.findall("I*[^I](?:I*$)?", audit)
                out["conv"] += [conv] * len(parts)
                out["at"] += range(conv, conv + len(parts))
                out["edits"] += parts
            return out

        return work

    return arrow_rows(found.select("conv", "audit"), make, schema)


class Writer:
    """Repaired rows of a conversation, hashed as they come."""

    def __init__(self):
        self.digest, self.role, self.empty = hashlib.sha256(), "0", True

    def write(self, role: str, text: str) -> None:
        self.digest.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.role, self.empty = role[:1], False

    def next_role(self) -> str:
        return "assistant" if self.role == "u" else "user"

    def apply(self, edits: str, role: str, text: str) -> None:
        """The edits of one row, and insertions around it."""
        for edit in edits:
            if edit == "I":
                self.write(self.next_role(), "")
            elif edit == "K":
                self.write(role, text)
            elif edit == "R":
                self.write(self.next_role(), text)


def repaired_hashes(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``conv, repaired_sha256``: rows of a conversation stream through one task in order."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField("conv", T.LongType()), T.StructField("repaired_sha256", T.StringType())])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, writer = None, Writer()
        for batch in batches:
            out: dict[str, list] = {c: [] for c in schema.names}
            for conv, *row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if conv != now:
                    if now is not None:
                        out["conv"].append(now)
                        out["repaired_sha256"].append(writer.digest.hexdigest())
                    now, writer = conv, Writer()
                writer.apply(*row)
            if out["conv"]:
                yield pa.RecordBatch.from_pydict(out, schema=target)
        if now is not None:
            yield pa.RecordBatch.from_pydict({"conv": [now], "repaired_sha256": [writer.digest.hexdigest()]}, schema=target)

    stream = rows.select("at", "role", "text").join(edits, "at").repartition("conv").sortWithinPartitions("conv", "at")
    return stream.select("conv", "edits", "role", "text").mapInArrow(run, schema)


def _count(fault: str) -> Column:
    return F.count_if(F.col("fault") == fault).alias(fault)


def repair(damaged: DataFrame) -> DataFrame:
    """One row for each conversation of ``conv_id, turn, role, text`` (no nulls but ids and turns): faults, the
    cheapest edits that mend it, and the hash of what they make."""
    rows = ordered(damaged)
    faults = materialise(with_faults(rows), "faults")
    found = materialise(audits(conversation_cells(block_cells(faults))), "audits")
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    facts = faults.groupBy("conv").agg(F.first("conv_id").alias("conv_id"), gaps, _count("blank"), _count("duplicate"), _count("truncated"))
    return facts.join(found, "conv").join(repaired_hashes(rows, edits_of_rows(found)), "conv").drop("conv")


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """One row for every conv_id of the table, also where the damage leaves no row."""
    done = repair(damage(conversations)).withColumnRenamed("conv_id", "_c")
    every = conversations.select("conv_id").distinct().join(done, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return every.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
