"""Cheapest repair of conversations by rank-convergence parallel Viterbi.

A repaired conversation has the roles ``(s?(ua)+)?``, by initials. Each row is kept, given
another role or deleted, and empty rows may be inserted; costs are fixed values below. What
the rest of a conversation costs from a row on is a vector over the four states of that
expression, and a row turns the vector after it into the one before it.

Conversations are cut into chunks, and all chunks are worked on at once. The last one of a
conversation knows the vector it starts from, its end; the others start from a speculative
one. In fix-up passes a chunk whose neighbour came out otherwise than assumed is rerun from
the neighbour's vector, beside the run before it, and only until the two vectors differ by a
constant: from there on so do all, and no more than the total changes. Passes end when no
chunk has a new start. Vectors are kept less their smallest entry, so two that differ by a
constant are the same, and as few different ones occur, a step is a look-up. The totals of the
chunks, stitched together, are the cost. With the exact vectors each chunk traces the edits
forward from every state it may be entered in, at each row the least letter among the cheapest;
walking over the chunks of a conversation picks the trace that applies.

Rows are put in order by ranges of (conversation, turn), so a conversation with most of all
rows is dealt over many tasks. Only one letter a row takes part in the work on chunks; a
conversation has at most ``MOST_CHUNKS``, of blocks of some 1,000 rows, so passes are bounded.
Texts are read once more for the repaired conversation's digest: block by block in a stream,
and for a conversation of several blocks in pieces that stream through one digest.

Edge cases: a null role or text counts as one space. Null ids form one conversation, null
turns come first. Rows that agree in turn are ordered by role, then by the text's SHA-256.
Rows that agree in everything are duplicates. A conversation that loses all rows has zeros
and the digest of nothing. A role other than those three is none of the expression's and may
be replaced. Other columns are not touched; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.common import written
from pricepanel.tables import null_safe_join

# Costs of edits.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FORMS = 20
BLOCK_BITS = 10
MOST_CHUNKS = 64
PIECE = 1 << 20
_BLANKS = " \t\n\x0b\f\r"
_INITIALS = "sua-"

# States: nothing yet, after the system's row, after a user's, after the assistant's.
_USER, _ASSISTANT = 2, 3
_NEXT = ({"s": 1, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER})
_FILLED = (_USER, _USER, _ASSISTANT, _USER)  # where an inserted or renamed row leads
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
_END = (0, 2 * INSERT, INSERT, 0)
_GUESS = (0, 0, 0, 0)
_TO_GO = ("", "II", "I", "")

Vector = tuple[int, int, int, int]
Action = tuple[str, int]


def damaged(
    conversations: DataFrame, conv_id: str, turn: str, role: str, text: str
) -> DataFrame:
    """Rows with the damage that the checksum of their id and turn asks for."""
    blank = F.lit(" ")
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), blank).alias("role"),
        F.coalesce(F.col(text), blank).alias("text"),
    )
    named = (F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn"))
    form = F.crc32(F.concat_ws(":", *named).cast("binary")) % FORMS
    copies = F.when(form == 0, 0).when(form == 3, 2).otherwise(1)
    return rows.select(
        "conv_id",
        "turn",
        F.when(form == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(form == 1, "")
        .when(form == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("__copy"),
    ).drop("__copy")


def in_order(rows: DataFrame) -> DataFrame:
    """Rows by conversation and place, ``at`` numbering them, with what their text shows."""
    ended = F.rtrim("text", F.lit(_BLANKS))
    told = rows.select(
        "*",
        F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
        (ended == "").alias("blank"),
        (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("truncated"),
        # Parts rows that agree in everything, so that they can be dealt over ranges.
        F.monotonically_increasing_id().alias("__tie"),
    )
    order = ["conv_id", "turn", "role", "digest", "__tie"]
    placed = told.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(
        placed.drop("__tie").withColumn("at", F.monotonically_increasing_id()), "repair-rows"
    )


def coded(ordered: DataFrame) -> DataFrame:
    """conv_id, at, turn and a letter for the role and the first fault of each row."""
    narrow = ordered.drop("text")
    firsts = narrow.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at"))
    marked = narrow.join(firsts.select("at", F.lit(True).alias("new")), "at", "left")
    fault = F.when(F.col("blank"), 1).when(F.col("new").isNull(), 2).when(F.col("truncated"), 3)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    letter = F.char(65 + 4 * kind + F.coalesce(fault, F.lit(0)))
    return marked.select("conv_id", "at", "turn", letter.alias("code"))


def chunked(codes: DataFrame, block_bits: int, most_chunks: int) -> DataFrame:
    """conv_id, chunk, whether it is the last, and its blocks with a letter for each row."""
    blocks = codes.groupBy("conv_id", F.shiftright("at", block_bits).alias("block")).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("at", "code")))["code"], "").alias("codes")
    )
    blocks = written(blocks, "repair-blocks")
    numbers = blocks.groupBy("conv_id").agg(
        F.min("block").alias("__first"), F.max("block").alias("__last"),
        F.count("*").alias("__n"),
    )
    # Only the blocks of the few conversations with several are looked at by conversation.
    several = written(numbers.where("__n > 1").drop("__first", "__last"), "repair-several")
    ranked = null_safe_join(blocks, several, ["conv_id"], "left").selectExpr(
        "conv_id", "block", "codes", "coalesce(__n, 1) AS __n"
    )
    place = (
        "CASE WHEN __n = 1 THEN 0 ELSE row_number() OVER "
        "(PARTITION BY conv_id ORDER BY block) - 1 END"
    )
    chunk = F.floor(F.expr(place) / F.ceil(F.col("__n") / most_chunks)).cast("int")
    chunks = (
        ranked.withColumn("chunk", chunk)
        .groupBy("conv_id", "chunk", "__n")
        .agg(F.sort_array(F.collect_list(F.struct("block", "codes"))).alias("blocks"))
    )
    last = F.floor((F.col("__n") - 1) / F.ceil(F.col("__n") / most_chunks)).cast("int")
    return written(
        chunks.select(
            "conv_id", "chunk", (F.col("chunk") == last).alias("last"),
            (F.col("__n") == 1).alias("single"), "blocks",
        ),
        "repair-chunks",
    )


class Steps:
    """Steps over rows backward, each worked out once for a vector and a letter."""

    def __init__(self) -> None:
        self.known: dict[tuple[Vector, str], tuple[Vector, int, tuple[Action, ...]]] = {}

    def before(self, after: Vector, code: str) -> tuple[Vector, int, tuple[Action, ...]]:
        """The vector before a row less its smallest entry, that entry, the best edit by state."""
        if (after, code) not in self.known:
            self.known[after, code] = self._work_out(after, code)
        return self.known[after, code]

    @staticmethod
    def _work_out(after: Vector, code: str) -> tuple[Vector, int, tuple[Action, ...]]:
        kind, fault = divmod(ord(code) - 65, 4)
        initial, extra = _INITIALS[kind], TRUNCATED * (fault == 3)
        edits = []
        for state in range(4):
            own = [(DELETE + after[state], "D", state)]
            if fault in (0, 3):
                to = _FILLED[state]
                own.append((extra + RENAME + after[to], "R", to))
                if (to := _NEXT[state].get(initial)) is not None:
                    own.append((extra + after[to], "K", to))
            edits.append(own)
        costs = [min(own)[0] for own in edits]
        # At most two rows are inserted in a row: beyond those states repeat.
        for _ in range(2):
            costs = [min(c, INSERT + costs[_FILLED[s]]) for s, c in enumerate(costs)]
        best = []
        for state, own in enumerate(edits):
            to = _FILLED[state]
            ways = [*own, (INSERT + costs[to], "I", to)]
            letter, to = min((letter, to) for cost, letter, to in ways if cost == costs[state])
            best.append((letter, to))
        least = min(costs)
        return tuple(c - least for c in costs), least, tuple(best)

    def run(self, codes: str, start: Vector) -> tuple[Vector, int]:
        """The vector before all rows and the sum of what was taken off, from the vector after."""
        vector, total = start, 0
        for code in reversed(codes):
            vector, least, _ = self.before(vector, code)
            total += least
        return vector, total

    def rerun(
        self, codes: str, old: Vector, new: Vector, old_end: Vector, old_total: int
    ) -> tuple[Vector, int]:
        """Like ``run`` from ``new``, given the run from ``old``, as far as the two differ."""
        change = 0
        for code in reversed(codes):
            if old == new:
                return old_end, old_total + change
            old, least, _ = self.before(old, code)
            change -= least
            new, least, _ = self.before(new, code)
            change += least
        return new, old_total + change

    def traces(
        self, blocks: list[str], end: Vector, last: bool, states: range
    ) -> list[tuple[int, list[tuple[int, str]]]]:
        """For each state on entry: the state at the end, and state and edits of each block."""
        actions, vector = [], end
        for codes in reversed(blocks):
            own = []
            for code in reversed(codes):
                vector, _, best = self.before(vector, code)
                own.append(best)
            actions.append(own[::-1])
        actions.reverse()
        found = []
        for state in states:
            parts = []
            for k, own in enumerate(actions):
                entered, edits = state, []
                for best in own:
                    letter = "I"
                    while letter == "I":
                        letter, state = best[state]
                        edits.append(letter)
                if last and k == len(actions) - 1:
                    edits.append(_TO_GO[state])
                parts.append((entered, "".join(edits)))
            found.append((state, parts))
        return found


def _illegal(kinds: str) -> int:
    """Neighbours that may not follow each other."""
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:], strict=False))


def _kinds(codes: str) -> str:
    return "".join(_INITIALS[(ord(c) - 65) // 4] for c in codes)


_VECTORS = "conv_id long, chunk int, last boolean, start array<int>, vector array<int>, total long"


def _first_runs(chunks: DataFrame) -> DataFrame:
    """Every chunk from its end, or from the speculative vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for batch in batches:
            starts, vectors, totals = [], [], []
            for blocks, last in zip(batch["blocks"].to_pylist(), batch["last"].to_pylist(), strict=True):
                start = _END if last else _GUESS
                vector, total = steps.run("".join(b["codes"] for b in blocks), start)
                starts.append(start)
                vectors.append(vector)
                totals.append(total)
            ints = pa.list_(pa.int32())
            yield pa.record_batch(
                [
                    batch["conv_id"], batch["chunk"], batch["last"], pa.array(starts, ints),
                    pa.array(vectors, ints), pa.array(totals, pa.int64()),
                ],
                ["conv_id", "chunk", "last", "start", "vector", "total"],
            )

    return chunks.mapInArrow(run, _VECTORS)


def _reruns(chunks: DataFrame) -> DataFrame:
    """Chunks with the results of their last run, rerun from the vector ``given``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for batch in batches:
            vectors, totals = [], []
            for row in batch.select(["blocks", "start", "given", "vector", "total"]).to_pylist():
                vector, total = steps.rerun(
                    "".join(b["codes"] for b in row["blocks"]),
                    tuple(row["start"]), tuple(row["given"]), tuple(row["vector"]), row["total"],
                )
                vectors.append(vector)
                totals.append(total)
            yield pa.record_batch(
                [
                    batch["conv_id"], batch["chunk"], batch["last"], batch["given"],
                    pa.array(vectors, pa.list_(pa.int32())), pa.array(totals, pa.int64()),
                ],
                ["conv_id", "chunk", "last", "start", "vector", "total"],
            )

    return chunks.mapInArrow(run, _VECTORS)


def converged(chunks: DataFrame) -> DataFrame:
    """Start, result and total of every chunk when each starts from its neighbour's result."""
    runs = written(_first_runs(chunks), "repair-runs")
    place = ["conv_id", "chunk"]
    while True:
        given = runs.where("chunk > 0").select(
            "conv_id", (F.col("chunk") - 1).alias("chunk"), F.col("vector").alias("given")
        )
        wrong = null_safe_join(runs.where("NOT last"), given, place, "inner").where("start <> given")
        wrong = written(wrong, "repair-wrong")
        if wrong.isEmpty():
            return runs
        again = _reruns(null_safe_join(wrong, chunks.select(*place, "blocks"), place, "inner"))
        right = null_safe_join(runs, wrong.select(*place), place, "left_anti")
        runs = written(right.unionByName(again), "repair-runs")


_TRACES = (
    "conv_id long, chunk int, single boolean, kinds string, illegal long, blank long, "
    "duplicate long, truncated long, n_rows long, "
    "traces array<struct<state:int,blocks:array<struct<block:long,state:int,edits:string>>>>"
)


def traced(chunks: DataFrame, runs: DataFrame) -> DataFrame:
    """The edits of each chunk for every state on entry, and its counts of faults."""

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                names = [b["block"] for b in row["blocks"]]
                letters = [b["codes"] for b in row["blocks"]]
                codes = "".join(letters)
                states = range(1 if row["chunk"] == 0 else 4)
                found = steps.traces(letters, tuple(row["start"]), row["last"], states)
                kinds = _kinds(codes)
                faults = [(ord(c) - 65) % 4 for c in codes]
                rows.append(
                    (
                        row["conv_id"], row["chunk"], row["single"], kinds[0] + kinds[-1],
                        _illegal(kinds), faults.count(1), faults.count(2), faults.count(3),
                        len(codes),
                        [
                            {
                                "state": state,
                                "blocks": [
                                    {"block": name, "state": s, "edits": e}
                                    for name, (s, e) in zip(names, parts, strict=True)
                                ],
                            }
                            for state, parts in found
                        ],
                    )
                )
            part = pa.struct([("block", pa.int64()), ("state", pa.int32()), ("edits", pa.string())])
            kinds_of = pa.struct([("state", pa.int32()), ("blocks", pa.list_(part))])
            schema = pa.schema(
                [
                    ("conv_id", pa.int64()), ("chunk", pa.int32()), ("single", pa.bool_()),
                    ("kinds", pa.string()), ("illegal", pa.int64()), ("blank", pa.int64()),
                    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("n_rows", pa.int64()),
                    ("traces", pa.list_(kinds_of)),
                ]
            )
            columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
            yield pa.record_batch(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    starts = runs.select("conv_id", "chunk", "start")
    return null_safe_join(chunks, starts, ["conv_id", "chunk"], "inner").mapInArrow(trace, _TRACES)


def _picked(found: DataFrame) -> DataFrame:
    """Each chunk with the blocks of the trace that applies, ``entered`` the state it starts in.

    A conversation has few chunks; their states are walked through as one array.
    """
    if found.where("chunk > 0").isEmpty():
        return found.withColumn("blocks", F.col("traces")[0]["blocks"]).drop("traces")
    ends = F.transform("traces", lambda t: t["state"])
    walks = found.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("chunk", ends.alias("ends")))).alias("chunks")
    )
    # The first chunk is entered in the first state; its traces have only that.
    entered = F.aggregate(
        "chunks",
        F.array(F.lit(0)),
        lambda states, c: F.concat(states, F.array(F.get(c["ends"], F.element_at(states, -1)))),
    )
    states = walks.select("conv_id", F.posexplode(entered).alias("chunk", "__entered"))
    joined = null_safe_join(found, states, ["conv_id", "chunk"], "inner")
    taken = F.get("traces", F.col("__entered"))["blocks"]
    return joined.withColumn("blocks", taken).drop("traces", "__entered")


def _boundaries() -> Column:
    """Illegal neighbours on both sides of a cut between chunks."""
    pairs = "zip_with(slice(kinds, 1, size(kinds) - 1), slice(kinds, 2, size(kinds) - 1), "
    pairs += "(a, b) -> if(concat(right(a, 1), left(b, 1)) IN ('su', 'ua', 'au'), 0, 1))"
    return F.expr(f"aggregate({pairs}, 0L, (n, x) -> n + x)")


def _lines(edits: str, state: int, rows: Iterator[tuple[str, str]]) -> Iterator[str]:
    """Lines of the repaired conversation, each after a line break."""
    for letter in edits:
        if letter == "I":
            state = _FILLED[state]
            yield f"\n{_NAMES[state]}:"
            continue
        role, text = next(rows)
        if letter == "R":
            state = _FILLED[state]
            yield f"\n{_NAMES[state]}:{text}"
        elif letter == "K":
            state = _NEXT[state][role[:1]]
            yield f"\n{role}:{text}"


def digests(ordered: DataFrame, picked: DataFrame, block_bits: int) -> DataFrame:
    """conv_id and the digest of its repaired rows."""
    edits = picked.select("conv_id", "single", F.explode("blocks").alias("b")).select(
        "conv_id", "single", "b.block", "b.state", "b.edits"
    )
    texts = ordered.select(
        "conv_id", F.shiftright("at", block_bits).alias("block"), "at", "role", "text"
    )
    place = ["conv_id", "block"]
    both = edits.unionByName(texts, allowMissingColumns=True)
    both = both.repartition(*place).sortWithinPartitions(*place, F.col("at").asc_nulls_first())

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "block", "piece", "sha", "data"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

        def stream() -> Iterator[dict]:
            for batch in batches:
                for k in range(batch.num_rows):
                    yield {name: batch[name][k].as_py() for name in batch.schema.names}

        rows = stream()
        row = next(rows, None)
        waiting: list[tuple] = []
        while row is not None:
            head = row  # the edits of a block come before its rows

            def own() -> Iterator[tuple[str, str]]:
                nonlocal row
                while row is not None and row["at"] is not None:
                    yield row["role"], row["text"]
                    row = next(rows, None)

            row = next(rows, None)
            texts_of = own()
            lines = _lines(head["edits"], head["state"], texts_of)
            key = (head["conv_id"], head["block"])
            if head["single"]:
                sha, skip = hashlib.sha256(), 1
                for line in lines:
                    sha.update(line[skip:].encode())
                    skip = 0
                waiting.append((*key, 0, sha.hexdigest(), None))
            else:
                piece, size, number = [], 0, 0
                for line in lines:
                    raw = line.encode()
                    for at in range(0, len(raw), PIECE):
                        piece.append(raw[at : at + PIECE])
                        size += len(piece[-1])
                        if size >= PIECE:
                            yield out([*waiting, (*key, number, None, b"".join(piece))])
                            waiting, piece, size, number = [], [], 0, number + 1
                waiting.append((*key, number, None, b"".join(piece)))
            for _ in texts_of:  # none is left
                pass
            if len(waiting) >= 1000 or not head["single"]:
                yield out(waiting)
                waiting = []
        if waiting:
            yield out(waiting)

    hashed = written(
        both.mapInArrow(repaired, "conv_id long, block long, piece long, sha string, data binary"),
        "repair-digests",
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sha, skip, begun = None, hashlib.sha256(), 1, False
        ids: list[int | None] = []
        shas: list[str] = []
        for batch in batches:
            for k in range(batch.num_rows):
                name, data = batch["conv_id"][k].as_py(), batch["data"][k].as_buffer()
                if begun and name != current:
                    ids.append(current)
                    shas.append(sha.hexdigest())
                    sha, skip = hashlib.sha256(), 1
                current, begun = name, True
                if data.size:
                    sha.update(memoryview(data)[skip:])
                    skip = 0
        if begun:
            ids.append(current)
            shas.append(sha.hexdigest())
        yield pa.record_batch(
            [pa.array(ids, pa.int64()), pa.array(shas, pa.string())], ["conv_id", "sha"]
        )

    several = (
        hashed.where("sha IS NULL")
        .select("conv_id", "block", "piece", "data")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "block", "piece")
        .mapInArrow(joined, "conv_id long, sha string")
    )
    return hashed.where("sha IS NOT NULL").select("conv_id", "sha").unionByName(several)


def repair(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    *,
    block_bits: int = BLOCK_BITS,
    most_chunks: int = MOST_CHUNKS,
) -> DataFrame:
    """One row per conversation: gaps, faults, the cost of the repair, its edits and digest."""
    ordered = in_order(damaged(conversations, conv_id, turn, role, text))
    codes = written(coded(ordered), "repair-codes")
    chunks = chunked(codes.select("conv_id", "at", "code"), block_bits, most_chunks)
    runs = converged(chunks)
    picked = written(_picked(traced(chunks, runs)), "repair-edits")

    turns = codes.groupBy("conv_id").agg(
        F.coalesce(
            F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)
        ).alias("gaps")
    )
    edits = F.array_join(F.transform("blocks", lambda b: b["edits"]), "")
    # As many entries as a conversation has chunks.
    per_chunk = F.sort_array(F.collect_list(F.struct("chunk", "kinds", edits.alias("edits"))))
    summed = (F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal"))
    found = picked.groupBy("conv_id").agg(*summed, per_chunk.alias("parts"))
    found = found.select(
        "conv_id", "blank", "duplicate", "truncated", "illegal",
        F.col("parts.kinds").alias("kinds"), F.array_join("parts.edits", "").alias("audit"),
    ).withColumn("illegal", F.col("illegal") + _boundaries())
    first = F.max(F.when(F.col("chunk") == 0, F.get("vector", F.lit(0))))
    costs = runs.groupBy("conv_id").agg((F.sum("total") + first).cast("long").alias("cost"))

    base = conversations.select(F.col(conv_id).cast("long").alias("conv_id")).distinct()
    parts = (turns, found.drop("kinds"), costs, digests(ordered, picked, block_bits))
    whole = reduce(lambda a, b: null_safe_join(a, b, ["conv_id"], "left"), parts, base)
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    nothing = hashlib.sha256().hexdigest()
    return whole.select(
        "conv_id",
        *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(nothing)).alias("repaired_sha256"),
    )
