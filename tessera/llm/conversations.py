"""Repair of conversation structure: the cheapest edits that give the roles
``(s?(ua)+)?``, by an integer-minimum dynamic program.

A state is what has been written so far: nothing, a system, a user or an
assistant row. An edit of a row, or an inserted row, is an edge. A path's weight
is one integer: its high digits are the cost, its low digits, at fixed places
from the left and ended by zeros, the letters of its edits; so the least integer
is the cheapest path, and of those the one with the least letters. Putting an
edge in front of a path moves the letters by a place, which keeps the order of
two weights.

Conversations of any length: the rows are put in order by ranges of
(conversation, turn), so one conversation may lie in many partitions, and
segments of at most ``SEGMENT`` rows give the least weight from each state to
each state. Segments merge in rounds of at most ``FAN``. (Between two states two
paths of equal cost over the same rows never differ by letters at the end alone,
as those would be inserted rows that cost more; so what is least in a segment
stays least.) Only the digest of the repaired text is sequential by its nature:
rows and edits stream through a task by conversation, and none is held."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import cut_lineage

SEGMENT, FAN = 256, 64
BLANKS = " \t\n\x0b\x0c\r"
#: Faults, and letters of the edits in ASCII order (0 ends).
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
LETTERS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(1, 5)
BITS = 3
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
LEFT_TRUNCATED = 5
#: From a state by a role's initial: 0 nothing, 1 system, 2 user, 3 assistant.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WRITTEN = {"u": "user", "a": "assistant"}
ENDS = {0: "", 3: "", 2: "I", 1: "II"}
INITIALS = "sua"
INSERTS = [(q, to, COST[INSERT], INSERT) for (q, c), to in NEXT.items() if c in WRITTEN]


def _edges(initial: str, fault: int) -> list[tuple[int, int, int, int]]:
    """(state, next state, cost, letter) of a row's edits."""
    out = [(q, q, COST[DELETE], DELETE) for q in range(4)]
    if fault in (SOUND, TRUNCATED):
        more = LEFT_TRUNCATED if fault == TRUNCATED else 0
        out += [(q, to, COST[KEEP] + more, KEEP) for (q, c), to in NEXT.items() if c == initial]
        out += [(q, to, COST[REROLE] + more, REROLE) for (q, c), to in NEXT.items() if c in WRITTEN]
    return out


EDGES = [_edges(initial, fault) for initial in [*INITIALS, ""] for fault in range(4)]


def _least(edges, ahead: list, to: list, width: int) -> list:
    """From each state the least of ``ahead`` and of the edges to ``to``."""
    out, mask = list(ahead), (1 << width) - 1
    for q, end, cost, letter in edges:
        if (w := to[end]) is not None:
            w = ((w >> width) + cost) << width | letter << width - BITS | (w & mask) >> BITS
            if out[q] is None or w < out[q]:
                out[q] = w
    return out


NOWHERE = [None] * 4


def segment_paths(codes: list[int]) -> list[tuple[int, int, int, int, int]]:
    """The least path of a segment's rows (initial * 4 + fault each) between
    any two states: (from, to, cost, letters, the letters as one integer)."""
    width = BITS * (3 * len(codes) + 1)
    out = []
    for end in range(4):
        paths: list = list(NOWHERE)
        paths[end] = 0
        for code in reversed(codes):
            paths = _least(EDGES[code], NOWHERE, paths, width)
            # At most two rows are inserted at a place: three write what one does.
            paths = _least(INSERTS, paths, _least(INSERTS, paths, paths, width), width)
        out += [(q, end, *_unpacked(w, width)) for q, w in enumerate(paths) if w is not None]
    return out


def _unpacked(weight: int, width: int) -> tuple[int, int, int]:
    cost, low = weight >> width, weight & (1 << width) - 1
    places = width // BITS - ((low & -low).bit_length() - 1) // BITS if low else 0
    return cost, places, low >> width - BITS * places


def merged_paths(segments: list[list[tuple]]) -> list[tuple[int, int, int, int, int]]:
    """The least paths over several segments in order."""
    width = BITS * sum(max(p[3] for p in s) for s in segments)
    mask = (1 << width) - 1
    out = []
    for end in range(4):
        paths: list = list(NOWHERE)
        paths[end] = 0
        for segment in reversed(segments):
            before: list = list(NOWHERE)
            for q, to, cost, places, letters in segment:
                if (w := paths[to]) is not None:
                    w = ((w >> width) + cost) << width | letters << width - BITS * places | (w & mask) >> BITS * places
                    if before[q] is None or w < before[q]:
                        before[q] = w
            paths = before
        out += [(q, end, *_unpacked(w, width)) for q, w in enumerate(paths) if w is not None]
    return out


def spelled(places: int, letters: int) -> str:
    """The letters that an integer holds."""
    if not places:
        return ""
    digits = format(letters, f"0{places}o")  # BITS bits are an octal digit
    return digits.translate({ord(str(k)): c for k, c in enumerate(LETTERS, 1)})


def best_edits(paths: list[tuple]) -> tuple[int, str]:
    """Cost and letters of the least whole path: it starts from nothing and
    ends complete."""
    whole = [(cost + COST[INSERT] * len(ENDS[to]), spelled(places, letters) + ENDS[to]) for q, to, cost, places, letters in paths if q == 0]
    return min(whole)


# Summaries of segments --------------------------------------------------------
_PATH = "struct<q: tinyint, to: tinyint, cost: bigint, places: bigint, letters: binary>"
_SUMMARY = f"n long, blank long, duplicate long, truncated long, illegal long, turns long, first string, last string, low long, high long, paths array<{_PATH}>"
_COUNTS = ["n", "blank", "duplicate", "truncated", "illegal", "turns"]
LEGAL = {"su", "ua", "au"}


def _bytes(x: int) -> bytes:
    return x.to_bytes(-(-x.bit_length() // 8), "big")


def _summary(rows: list[dict]) -> dict:
    codes = [r["code"] for r in rows]
    initials = [(INITIALS + "-")[c // 4] for c in codes]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    faults = [c % 4 for c in codes]
    return {
        "n": len(rows), "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "turns": len(set(turns)), "first": initials[0], "last": initials[-1],
        "low": turns[0] if turns else None, "high": turns[-1] if turns else None,
        "paths": segment_paths(codes),
    }


def _joined(parts: list[dict]) -> dict:
    """Parts of one conversation in order as one."""
    out = {c: sum(p[c] for p in parts) for c in _COUNTS}
    out["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:], strict=False))
    numbered = [p for p in parts if p["low"] is not None]
    out["turns"] -= sum(a["high"] == b["low"] for a, b in zip(numbered, numbered[1:], strict=False))
    paths = [[(p["q"], p["to"], p["cost"], p["places"], int.from_bytes(p["letters"], "big")) for p in part["paths"]] for part in parts]
    return out | {"first": parts[0]["first"], "last": parts[-1]["last"], "low": numbered[0]["low"] if numbered else None, "high": numbered[-1]["high"] if numbered else None, "paths": merged_paths(paths)}


def _summaries(make, id_type: T.DataType):
    """An Arrow function over rows (conv, seg, list): ``make`` sums up the list."""
    schema = T.StructType([T.StructField("conv", id_type), T.StructField("seg", T.LongType()), *T._parse_datatype_string(_SUMMARY).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [make(x) for x in batch.column(2).to_pylist()]
            for m in made:
                m["paths"] = [{"q": q, "to": to, "cost": cost, "places": places, "letters": _bytes(letters)} for q, to, cost, places, letters in m["paths"]]
            types = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.int64()] * 2
            types.append(pa.list_(pa.struct([("q", pa.int8()), ("to", pa.int8()), ("cost", pa.int64()), ("places", pa.int64()), ("letters", pa.binary())])))
            columns = [pa.array([m[name] for m in made], t) for name, t in zip(schema.names[2:], types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=schema.names)

    return run, schema


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Result columns of each conversation but the digest."""
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    for batch in batches:
        rows = []
        for part in pa.Table.from_batches([batch.select(batch.schema.names[2:])]).to_pylist():
            gaps = part["high"] - part["low"] + 1 - part["turns"] if part["low"] is not None else 0
            cost, audit = best_edits([(p["q"], p["to"], p["cost"], p["places"], int.from_bytes(p["letters"], "big")) for p in part["paths"]])
            rows.append((gaps, *(part[c] for c in names[1:5]), cost, audit))
        columns = zip(*rows, strict=True) if rows else ((),) * 7
        types = [pa.int64()] * 6 + [pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["conv", *names, "audit"])


def in_order(rows: DataFrame) -> DataFrame:
    """A written table (conv, turn, role, text, place, code, digest): rows by
    conversation and turn (null first), numbered from 0 without gaps. Equal
    turns are ordered by role, by the first 64 code points of the text and by a
    hash of the whole, so that ranges can part any group of rows. A null text or
    role reads as one space."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    rows = rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), role, text, F.monotonically_increasing_id().alias("salt"))
    by = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("start"), F.asc("hash"), F.asc("salt")]
    rows = rows.withColumns({"start": F.left("text", F.lit(64)), "hash": F.xxhash64("text")})
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    solid = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(solid == "", F.lit(BLANK)).when(~F.right(solid, F.lit(1)).isin(".", "!", "?"), F.lit(TRUNCATED)).otherwise(F.lit(SOUND))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    laid = cut_lineage(rows.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("at"), (_initial() * 4 + fault).cast("int").alias("code"), digest.alias("digest")))
    spark = rows.sparkSession
    # A row for each partition of the sort.
    begin, begins = 0, []
    for p, n in sorted(laid.groupBy(F.shiftright("at", 33)).count().collect()):
        begins.append((p, begin))
        begin += n
    begins = spark.createDataFrame(begins, "part long, begin long")
    laid = laid.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(begins), "part")
    return laid.select("conv", "turn", "role", "text", (F.col("begin") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("place"), "code", "digest")


def _initial() -> Column:
    first = F.left("role", F.lit(1))
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def edits(laid: DataFrame, segment: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of each
    conversation of ``laid``, as from ``in_order``."""
    marks = laid.select("conv", "turn", "place", "code", "digest")
    firsts = marks.groupBy("conv", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("is_first"))
    again = F.col("is_first").isNull() & (F.col("code") % 4 != BLANK)
    code = F.when(again, F.floor(F.col("code") / 4) * 4 + DUPLICATE).otherwise(F.col("code")).cast("int")
    rows = marks.join(firsts, "place", "left").select("conv", F.floor(F.col("place") / segment).alias("seg"), F.struct("place", "turn", code.alias("code")).alias("row"))
    id_type = laid.schema["conv"].dataType
    run, schema = _summaries(_summary, id_type)
    parts = rows.groupBy("conv", "seg").agg(F.array_sort(F.collect_list("row")).alias("rows")).mapInArrow(run, schema)
    run, schema = _summaries(_joined, id_type)
    whole = ["seg", *schema.names[2:]]
    while True:
        parts = cut_lineage(parts)
        most = parts.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
        seg = F.lit(0).cast("long") if most <= fan else F.floor(F.col("seg") / fan)
        if most > 1:
            listed = parts.groupBy("conv", seg.alias("next")).agg(F.array_sort(F.collect_list(F.struct(*whole)), _by_segment).alias("parts"))
            parts = listed.select("conv", F.col("next").alias("seg"), "parts").mapInArrow(run, schema)
        if most <= fan:
            return parts.mapInArrow(_headers, T.StructType([T.StructField("conv", id_type), *T._parse_datatype_string("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string").fields]))


def _by_segment(a: Column, b: Column) -> Column:
    return F.when(a["seg"] < b["seg"], -1).when(a["seg"] > b["seg"], 1).otherwise(0)


_RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The stream of rows sorted by conversation and place, each conversation
    headed by its edits: ("open", conv, header), ("row", conv, role, text) for
    what stays, ("close", conv)."""
    head, conv, letters, state = None, None, iter(""), 0

    def inserted() -> Iterator[tuple]:
        nonlocal state
        for letter in letters:
            if letter != "I":
                return letter
            initial = "a" if state == 2 else "u"
            state = NEXT[state, initial]
            yield "row", conv, WRITTEN[initial], ""
        return None

    for batch in batches:
        for c, place, role, text, header in zip(*(batch.column(k) for k in range(5)), strict=True):
            if place.as_py() < 0:
                if head is not None:
                    yield from inserted()
                    yield "close", conv
                head, conv, state = header.as_py(), c.as_py(), 0
                letters = iter(head["audit"] or "")
                yield "open", conv, head
                continue
            letter = yield from inserted()
            if letter == "K":
                state = NEXT[state, role.as_py()[0]]
                yield "row", conv, role.as_py(), text.as_py()
            elif letter == "R":
                initial = "a" if state == 2 else "u"
                state = NEXT[state, initial]
                yield "row", conv, WRITTEN[initial], text.as_py()
    if head is not None:
        yield from inserted()
        yield "close", conv


def _stream(laid: DataFrame, headed: DataFrame) -> DataFrame:
    """Rows and headers (of every conversation) together, by conversation."""
    none = F.lit(None).cast("string")
    heads = headed.select("conv", F.lit(-1).cast("long").alias("place"), none.alias("role"), none.alias("text"), F.struct(*_RESULT).alias("header"))
    rows = laid.select("conv", "place", "role", "text").withColumn("header", F.lit(None).cast(heads.schema["header"].dataType))
    return heads.unionByName(rows).repartition("conv").sortWithinPartitions("conv", "place")


def repair(rows: DataFrame, ids: DataFrame | None = None, **how) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256 of each conversation of ``rows`` (conv_id, turn, role, text),
    and of each conv_id in ``ids``.

    A null conv_id is a conversation like any other. A null text or role reads as
    one space, so such a text is blank and such a role must be changed. Rows of
    one turn are in the order that ``in_order`` defines; repeated rows are
    duplicates of the first. Texts of any length are read whole. A conversation
    without rows has zeros, an empty audit and the digest of nothing. Further
    columns are ignored; an empty table gives an empty one."""
    laid = cut_lineage(in_order(rows))
    found = edits(laid, **how)
    if ids is not None:
        names = ids.select(F.col("conv_id").alias("name")).distinct()
        found = names.join(found, names["name"].eqNullSafe(found["conv"]), "left").select(
            F.col("name").alias("conv"), *(F.coalesce(c, F.lit("" if c == "audit" else 0)).alias(c) for c in _RESULT))
    found = found.select("conv", *(F.col(c).cast("string" if c == "audit" else "long").alias(c) for c in _RESULT))
    schema = T.StructType([T.StructField("conv_id", laid.schema["conv"].dataType), *T._parse_datatype_string(", ".join(f"{c} {'string' if c == 'audit' else 'long'}" for c in _RESULT)).fields, T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest, before, arrow_id = [], None, b"", None

        def typed(batches):
            nonlocal arrow_id
            for batch in batches:
                arrow_id = batch.column(0).type
                yield batch

        def packed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * 9
            types = [arrow_id, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

        for kind, conv, *what in _repaired(typed(batches)):
            if kind == "open":
                head, digest, before = what[0], hashlib.sha256(), b""
            elif kind == "row":
                digest.update(before + what[0].encode() + b":")
                digest.update(what[1].encode("utf-8", "surrogatepass"))
                before = b"\n"
            else:
                out.append((conv, *(head[c] for c in _RESULT), digest.hexdigest()))
                if len(out) >= 4096:
                    yield packed()
                    out = []
        if out:
            yield packed()

    return _stream(laid, found).mapInArrow(run, schema)


def repaired_rows(rows: DataFrame, **how) -> DataFrame:
    """conv_id, place, role and text of the repaired conversations; places count
    from 0 in each. Cases as in ``repair``."""
    laid = cut_lineage(in_order(rows))
    schema = T.StructType([T.StructField("conv_id", laid.schema["conv"].dataType), *T._parse_datatype_string("place long, role string, text string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, place, types = [], 0, 0, None

        def typed(batches):
            nonlocal types
            for batch in batches:
                types = [batch.column(0).type, pa.int64(), pa.string(), pa.string()]
                yield batch

        for kind, conv, *what in _repaired(typed(batches)):
            if kind == "open":
                place = 0
            elif kind == "row":
                out.append((conv, place, *what))
                place, size = place + 1, size + len(what[1])
                if len(out) >= 4096 or size >= 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=schema.names)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=schema.names)

    return _stream(laid, edits(laid, **how)).mapInArrow(run, schema)


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults by the CRC of
    ``conv_id:turn`` (nulls: one space) modulo 20: 0 drops the row, 1 empties its
    text, 2 takes out ``[.!?]``, 3 repeats it, 4 makes its role user."""
    named = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")))
    kind = F.crc32(named.cast("binary")) % 20
    rows = rows.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")
