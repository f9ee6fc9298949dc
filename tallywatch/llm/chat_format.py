"""Chat formatting: conversations rendered by a compiled template, with marks on the text to be learned."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallywatch.llm import common
from tallywatch.llm.chat_template import compile_template

# The format's control strings, the template, and the conversation that every result has too.
HEAD, STOP, BACKSLASH = "###", "</turn>", "\\"
TEMPLATE = (
    "{% for turn in turns %}### {{ turn.role | escape_role }}: "
    '{% if turn.role == "assistant" %}{% generation %}{{ turn.text | escape }}{% endgeneration %}'
    "{% else %}{{ turn.text | escape }}{% endif %}</turn>\n{% endfor %}"
)
EXTRA_ID, EXTRA_TEXT = -7, r"\### Assistant: </turn> ok"

_IN_TEXT = re.compile(r"\\|###|</turn>")
_IN_ROLE = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_STOP_OR_ESCAPED = re.compile(r"\\(?:\\|###|</turn>|:)|</turn>")
_COLON_OR_ESCAPED = re.compile(r"\\(?:\\|###|</turn>|:)|: ")


def escape(text: object) -> str:
    return _IN_TEXT.sub(lambda m: BACKSLASH + m[0], "" if text is None else str(text))


def escape_role(role: object) -> str:
    return _IN_ROLE.sub(lambda m: BACKSLASH + m[0], "" if role is None else str(role))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


FILTERS = {"escape": escape, "escape_role": escape_role}


def _runs(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Neighbouring rows with the same first field, as an iterator for each such run; rows are never gathered."""
    row = next(rows, None)
    while row is not None:
        key = row[0]

        def run() -> Iterator[tuple]:
            nonlocal row
            while row is not None and row[0] == key:
                yield row
                row = next(rows, None)

        of_key = run()
        yield key, of_key
        for _ in of_key:  # what the caller left unread
            pass


def format_pieces(conversations: DataFrame, template: str = TEMPLATE, filters: dict | None = None) -> DataFrame:
    """The formatted conversations as pieces: conv_id, seq, piece, learned. Joined by seq they are the whole text.

    Rows are dealt by conversation, sorted by turn, and rendered one turn after the other, so memory is bounded by a turn
    even if one conversation holds a third of all rows. Partitions hold whole conversations with their pieces in order.

    A null text or role is empty; rows of a null conv_id are one conversation; turns of the same number, repeated rows
    too, follow by role and text. An empty table gives no rows; other columns are ignored.
    """
    compile_template(template, filters or FILTERS)  # a wrong template fails here, not in a task
    turns = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = conversations.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("seq", T.LongType()), T.StructField("piece", T.StringType()), T.StructField("learned", T.BooleanType())])
    arrow = to_arrow_schema(schema)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        program = compile_template(template, filters or FILTERS)
        rows = common.arrow_rows(batches, ["conv_id", "role", "text"])

        def pieces() -> Iterator[tuple]:
            for conv_id, run in _runs(rows):
                said = ({"role": role or "", "text": text or ""} for _, role, text in run)
                for seq, (piece, learned) in enumerate(program({"turns": said})):
                    yield conv_id, seq, piece, learned

        yield from common.arrow_batches(pieces(), arrow)

    return turns.mapInArrow(render, schema)


def formatted(pieces: DataFrame) -> DataFrame:
    """One row per conversation: its text and the [start, end) character spans to be learned. For conversations that fit a row."""
    parts = F.sort_array(F.collect_list(F.struct("seq", "piece", "learned")))
    length = F.transform("parts", lambda p: F.char_length(p["piece"]))
    starts = F.transform("parts", lambda p, i: F.aggregate(F.slice("lengths", F.lit(1), i), F.lit(0), lambda a, b: a + b))
    spans = F.transform(F.filter(F.arrays_zip("parts", "starts", "lengths"), lambda x: x["parts"]["learned"]), lambda x: F.struct(x["starts"].alias("start"), (x["starts"] + x["lengths"]).alias("end")))
    return (
        pieces.groupBy("conv_id").agg(parts.alias("parts")).withColumn("lengths", length).withColumn("starts", starts)
        .select("conv_id", F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("text"), spans.alias("learned_spans"))
    )


def _read_turn(buffer: str) -> tuple[str, str, str] | None:
    """Role, text and what follows of the first whole turn in the formatted text, if it has one."""
    end = next((m for m in _STOP_OR_ESCAPED.finditer(buffer) if m[0] == STOP), None)
    if end is None or len(buffer) <= end.end():
        return None
    head = next(m for m in _COLON_OR_ESCAPED.finditer(buffer) if m[0] == ": ")
    if not buffer.startswith(HEAD + " ") or buffer[end.end()] != "\n":
        raise ValueError("not a formatted conversation")
    return unescape(buffer[len(HEAD) + 1 : head.start()]), unescape(buffer[head.end() : end.start()]), buffer[end.end() + 1 :]


def read_back(pieces: DataFrame) -> DataFrame:
    """What the formatted text says, read turn by turn: counts and digests of the turns and of the text to be learned.

    Takes the output of ``format_pieces`` with the default template as it is: conversations whole and in order.
    """
    kind = pieces.schema["conv_id"].dataType
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [kind, T.LongType(), T.StringType(), T.LongType(), T.StringType(), T.LongType()]

    def digest(conv_id: object, run: Iterator[tuple]) -> tuple:
        turns, loss, n_turns, loss_chars, chars, buffer, learned_text = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, "", ""
        for _, piece, learned in run:
            chars += len(piece)
            buffer += piece
            if learned:
                learned_text += piece
            elif learned_text:
                text = unescape(learned_text)
                loss.update(text.encode())
                loss_chars, learned_text = loss_chars + len(text), ""
            while STOP in piece and (turn := _read_turn(buffer)):
                role, text, buffer = turn
                turns.update(f"{role}\n{text}\n".encode())
                n_turns += 1
        if buffer or learned_text:
            raise ValueError("the text ends inside a turn")
        return conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types, strict=True)])
    arrow = to_arrow_schema(schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _runs(common.arrow_rows(batches, ["conv_id", "piece", "learned"]))
        yield from common.arrow_batches((digest(k, run) for k, run in runs), arrow)

    return pieces.mapInArrow(fold, schema)


def with_extra(conversations: DataFrame) -> DataFrame:
    rows = [(EXTRA_ID, 0, "user", EXTRA_TEXT), (EXTRA_ID, 1, "assistant", EXTRA_TEXT)]
    extra = conversations.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(format_pieces(with_extra(common.table(spark, sf_dir, "conversations"))))


OP7_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length(regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g')) + 2
    + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')) + 8) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
