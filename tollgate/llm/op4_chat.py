"""Chat formatting in budgeted windows.

Turns get their token counts, and prefix sums of these along the conversation choose the
windows.  The room of a window is the budget less the history and the system turn; a turn that
starts at prefix p belongs to stretch p div (room / 2), and a turn larger than half the room
stands alone.  So a window holds less than the room unless one turn alone is larger, every
boundary is a turn boundary, and a turn's window follows from its prefix sum alone: no task
walks along a whole conversation.  Prefix sums are taken within parts of a conversation
(by turn number) and shifted by the sums of the parts before.

Every window after the first repeats the conversation's system turn and the last turns before
it, up to ``history`` tokens.  The loss mask covers the text of assistant turns that the window
brings for the first time; repeated ones are masked out, so each target is learned once.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``.  Within texts and roles a backslash is put
behind each ``<`` that a ``|`` or a backslash follows, so texts never hold ``<|``; reading
back takes it out.  In roles, backslashes and line ends are written as ``\\\\`` and ``\\n`` first.

``read_back`` parses the windows again, drops the repeated turns and gives digests of each
conversation; it streams over windows in order and keeps one conversation's hash states.

Defined cases: null roles and texts are empty; a null turn comes first; equal turns are
ordered by role and text; null conv_ids make one conversation; a conversation without a
system turn repeats none; a system turn later than the first is a turn like others; a turn
larger than the budget is kept whole; empty tables give empty results; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, text_batches
from .op6_wavelet import encoder
from .registry import register

START, END = "<|im_start|>", "<|im_end|>"
VOCABULARY = "byte_bpe_50k.json"
BUDGET = 1024
HISTORY = 128
#: Tokens that the template adds to a turn.
FRAME_TOKENS = 5
#: Smallest room of a window, however long the system turn is.
LEAST_ROOM = 64
#: Turn numbers in one part of a conversation's prefix sums.
PART_TURNS = 1024


def escape(text: str) -> str:
    return re.sub(r"<([\\|])", r"<\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\([\\|])", r"<\1", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def turn_tokens(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds ``tokens`` to (conv_id, turn, role, text) rows."""
    schema = turns.select(turns.columns).schema.add("tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary)
        for batch, texts in text_batches(batches, 3):
            n = [len(e.encode((t or b"").decode("utf-8", "replace"))) // e.width + FRAME_TOKENS for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], names=[*batch.schema.names, "tokens"])

    return turns.mapInArrow(run, schema)


def windows(spark: SparkSession, turns: DataFrame, budget: int = BUDGET, history: int = HISTORY,
            vocabulary: str = VOCABULARY) -> DataFrame:
    """conv_id, start (tokens of the conversation before the window), formatted, spans (start
    and end in code points of ``formatted``, the loss mask), n_repeated (turns at the front
    that are repeated), n_turns (all turns of the window), n_tokens."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = turn_tokens(rows, vocabulary).withColumn("k", F.struct(F.col("conv_id").isNull().alias("no"),
                                                                   F.coalesce("conv_id", F.lit(0)).alias("id")))
    # prefix sums: within parts, and over the parts of a conversation
    rows = rows.withColumn("part", F.coalesce(F.floor(F.col("turn") / PART_TURNS), F.lit(-2**62)))
    inside = Window.partitionBy("k", "part").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = (rows.withColumn("in_part", F.coalesce(F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("nth", F.row_number().over(inside)))
    ends = rows.groupBy("k", "part").agg(F.sum("tokens").alias("sum"),
                                         F.max(F.when(F.col("nth") == 1, F.struct("role", "text", "tokens"))).alias("first"))
    along = Window.partitionBy("k").orderBy("part")
    ends = (ends.withColumn("shift", F.coalesce(F.sum("sum").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("first", F.first("first").over(along.rowsBetween(Window.unboundedPreceding, 0))))
    system = F.when(F.col("first.role") == "system", F.col("first"))
    rows = rows.join(ends.select("k", "part", "shift", system.alias("system")), ["k", "part"])
    before = (F.col("in_part") + F.col("shift")).alias("before")
    half = F.floor(F.greatest(F.lit(budget - history) - F.coalesce(F.col("system.tokens"), F.lit(0)), F.lit(LEAST_ROOM)) / 2)
    rows = rows.select("k", "role", "text", "tokens", "system", before, half.alias("half"))
    # a large turn is the last to start in its stretch
    rows = rows.withColumn("stretch", F.floor(F.col("before") / F.col("half"))).withColumn("alone", F.col("tokens") > F.col("half"))
    same = Window.partitionBy("k", "stretch", "alone")
    rows = (rows.withColumn("start", F.min("before").over(same))
            .withColumn("stop", F.max(F.col("before") + F.col("tokens")).over(same)))
    # a turn close enough to its window's end is history of the next window, which starts there
    is_system = (F.col("before") == 0) & F.col("system").isNotNull()
    again = (F.col("stop") - F.col("before") <= history) & ~is_system
    copies = F.when(again, F.array(F.struct(F.col("start").alias("at"), F.lit(0).alias("old")),
                                   F.struct(F.col("stop").alias("at"), F.lit(1).alias("old")))).otherwise(
        F.array(F.struct(F.col("start").alias("at"), F.lit(0).alias("old"))))
    rows = rows.withColumn("w", F.explode(copies))
    grouped = rows.groupBy("k", F.col("w.at").alias("start")).agg(
        F.sort_array(F.collect_list(F.struct("before", "w.old", "role", "text", "tokens"))).alias("turns"),
        F.max(F.when((F.col("w.at") > 0), F.col("system"))).alias("system"))
    # nothing starts behind the last turn
    grouped = grouped.where(F.exists("turns", lambda t: t["old"] == 0))
    return grouped.select(F.when(~F.col("k.no"), F.col("k.id")).alias("conv_id"), "start", "turns", "system").mapInArrow(
        _format, "conv_id long, start long, formatted string, spans array<struct<start:long,end:long>>, "
        "n_repeated int, n_turns int, n_tokens long")


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            out: dict[str, list] = {c: [] for c in ("formatted", "spans", "n_repeated", "n_turns", "n_tokens")}
            for turns, system in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                turns = ([dict(system, old=1)] if system else []) + turns
                parts, spans, length = [], [], 0
                for t in turns:
                    head, text = f"{START}{escape_role(t['role'])}\n", escape(t["text"])
                    if t["role"] == "assistant" and not t["old"]:
                        spans.append({"start": length + len(head), "end": length + len(head) + len(text)})
                    parts += [head, text, END, "\n"]
                    length += len(head) + len(text) + len(END) + 1
                for c, v in (("formatted", "".join(parts)), ("spans", spans), ("n_repeated", sum(t["old"] for t in turns)),
                             ("n_turns", len(turns)), ("n_tokens", sum(t["tokens"] for t in turns))):
                    out[c].append(v)
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(out["formatted"], pa.string()), pa.array(out["spans"], spans_type),
                pa.array(out["n_repeated"], pa.int32()), pa.array(out["n_turns"], pa.int32()), pa.array(out["n_tokens"], pa.int64())],
                names=["conv_id", "start", "formatted", "spans", "n_repeated", "n_turns", "n_tokens"])


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted window."""
    out = []
    for piece in formatted.split(START)[1:]:
        head, _, rest = piece.partition("\n")
        if not rest.endswith(END + "\n"):
            raise ValueError("a turn is not closed")
        out.append((unescape_role(head), unescape(rest[:-len(END) - 1])))
    return out


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        state: list | None = None
        done: list = []

        def flush() -> pa.RecordBatch:
            rows = [(c, n, t.hexdigest(), chars, x.hexdigest(), size) for c, n, t, chars, x, size in done]
            done.clear()
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            for at in range(batch.num_rows):
                conv, text, spans, repeated = (batch.column(i)[at].as_py() for i in range(4))
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in parse(text)[repeated:]:
                    state[1] += 1
                    state[2].update(f"{role}\n{body}\n".encode())
                for s in spans:
                    target = unescape(text[s["start"]:s["end"]])
                    state[3] += len(target)
                    state[4].update(target.encode())
                state[5] += len(text)
            if done:
                yield flush()
        if state is not None:
            done.append(state)
            yield flush()

    return (formatted.select("conv_id", "formatted", "spans", "n_repeated", "start").repartition("conv_id")
            .sortWithinPartitions("conv_id", "start").select("conv_id", "formatted", "spans", "n_repeated")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                        "formatted_chars long"))


@register("op4_chat_format")
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = f"{END}{START}assistant ok"
    extra = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"),
                 F.lit(said).alias("text")) for i, role in enumerate(("user", "assistant"))])))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionAll(extra)
    return read_back(windows(spark, turns))
