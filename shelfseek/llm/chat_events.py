"""Chat formatting from event logs: fold streamed deltas, edits and regenerations into final messages, then render.

An event is (conv_id, turn, seq, kind, role, text). ``message``, ``edit`` and ``regenerate`` start their turn anew with
the event's text; ``delta`` adds to it. An edit also takes back what later turns said before it, as that answered the
old text. Logs are partitioned by conversation and sorted by turn and sequence; window functions, whose frames stream
and spill, decide which events last, and the texts that last are folded and rendered as a stream, one event at a time,
so that a very long conversation takes no more memory than its longest message.

The template puts ``<|im_start|>role``, a line break, the text and ``<|im_end|>``, a line break. Control strings
in texts and roles are escaped reversibly: backslashes are doubled and one is put after a control string's first
character, so the output never holds a control string that the template has not set.

Defined results: null texts count as empty and null roles as the empty role; an unknown or null kind is a message;
events with equal turn and sequence are ordered by role and text, with nulls first; null conversation ids form one
conversation; rows repeated in full are repeated turns of a conversation table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The template's and other common templates' control strings.
CONTROLS = re.compile(r"(<)(?=\||/?s>|<SYS>>|</SYS>>)|(\|)(?=>)|(\[)(?=/?INST\])")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
PIECE = re.compile(r"<\|im_start\|>((?:[^\n\\]|\\.)*)\n(.*)<\|im_end\|>\n", re.DOTALL)
START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

EVENTS = "conv_id {id}, turn bigint, seq bigint, kind string, role string, text string"
PIECES = "conv_id {id}, turn bigint, role string, formatted string, loss_start bigint, loss_end bigint"


def escape(text: str) -> str:
    return CONTROLS.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\\n")


def events_of(conversations: DataFrame) -> DataFrame:
    """A table of whole turns as events, each row a turn of its own."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", F.col("role").cast("string"), F.col("text").cast("string"))
    number = (F.row_number().over(order) - 1).cast("bigint")
    return rows.select(
        "conv_id", number.alias("turn"), F.lit(0).cast("bigint").alias("seq"), F.lit("message").alias("kind"), "role", "text"
    )


def lasting(events: DataFrame) -> DataFrame:
    """Events that no later one has taken back, sorted by conversation, turn and sequence inside partitions."""
    starts = ~F.col("kind").eqNullSafe("delta")
    own = Window.partitionBy("conv_id", "turn")
    earlier = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    marked = events.select(
        "conv_id",
        "turn",
        "seq",
        "role",
        "text",
        F.max(F.when(starts, F.col("seq"))).over(own).alias("_begun"),
        F.max(F.when(F.col("kind") == "edit", F.col("seq"))).over(earlier).alias("_edited"),
    )
    kept = marked.filter(
        (F.coalesce(F.col("seq") >= F.col("_begun"), F.lit(True)))
        & F.coalesce(F.col("seq") > F.col("_edited"), F.lit(True))
    )
    return kept.drop("_begun", "_edited").sortWithinPartitions("conv_id", "turn", "seq", "role", "text")


def id_type(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def render(events: DataFrame) -> DataFrame:
    """A formatted piece per final message, in order inside partitions; a conversation is its pieces joined. The loss
    mask is the code points from loss_start to loss_end of the piece, none where the role is not the assistant's."""
    kept = lasting(events)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_turn, role, parts = None, "", []
        made: list[tuple] = []
        for batch in batches:
            for conv, turn, _, said, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (conv, turn) != open_turn:
                    if open_turn is not None:
                        made.append(piece(*open_turn, role, "".join(parts)))
                    open_turn, role, parts = (conv, turn), said or "", []
                role = role or said or ""
                parts.append(text or "")
            yield from batch_of(made, batch.schema.field(0).type)
            made = []
        if open_turn is not None:
            yield from batch_of([piece(*open_turn, role, "".join(parts))], batch.schema.field(0).type)

    return kept.mapInArrow(run, PIECES.format(id=id_type(events)))


def piece(conv: object, turn: int, role: str, text: str) -> tuple:
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    loss = (len(head), len(head) + len(body)) if role == LOSS_ROLE else (None, None)
    return (conv, turn, role, f"{head}{body}{END}\n", *loss)


def batch_of(rows: list[tuple], id_kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    kinds = (id_kind, pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
    names = ("conv_id", "turn", "role", "formatted", "loss_start", "loss_end")
    if rows:
        columns = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))


def read_back(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted piece."""
    found = PIECE.fullmatch(formatted)
    return unescape(found[1]), unescape(found[2])


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation, read back from the formatted pieces as ``render`` orders them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            columns = (batch[name].to_pylist() for name in ("conv_id", "formatted", "loss_start", "loss_end"))
            for conv, formatted, loss_start, loss_end in zip(*columns, strict=True):
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, *finished(state)))
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_back(formatted)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if loss_start is not None:
                    learned = unescape(formatted[loss_start:loss_end])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(formatted)
            yield from digest_batch(done, batch.schema.field("conv_id").type)
        if state is not None:
            yield from digest_batch([(now, *finished(state))], batch.schema.field("conv_id").type)

    schema = (
        f"conv_id {id_type(pieces)}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint"
    )
    return pieces.mapInArrow(run, schema)


def finished(state: list) -> tuple:
    return (state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])


def digest_batch(rows: list[tuple], id_kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    kinds = (id_kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    if rows:
        columns = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def op7(spark, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    fixed = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return digests(render(events_of(given.unionByName(fixed))))
