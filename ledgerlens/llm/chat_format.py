"""Chat formatting from event logs.

A conversation is a log of events, in the order of ``seq``:

* ``start``: message ``message`` (a number that orders the messages) begins,
  with a role;
* ``delta``: text streamed to the end of that message;
* ``edit``: the message's text so far is replaced by the event's text;
* ``regenerate``: the message's text so far is discarded, and so are all later
  messages begun before this event; deltas that follow build the new text.

``fold_events`` folds a log into final messages, ``render`` writes them with a
template, and ``read_back`` parses what was written. The fold is partitioned by
(conversation, message): the last event that resets a message's text decides
which of its deltas count, so a conversation with a large share of all events
spreads over tasks, and the memory needed is that of one message's deltas.

Template: ``<|im_start|>role`` line break, the text, ``<|im_end|>`` line break.
Control strings inside texts are escaped reversibly: each backslash is
doubled, then a backslash goes behind the first character of each control
string. A lone backslash is therefore always an escape.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import clustered

#: The template's marks and the control strings of common chat
#: templates, none of which may stand in a text unescaped.
TURN, END = "<|im_start|>", "<|im_end|>\n"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")

_AFTER = "|".join(re.escape(c[1:]) for c in CONTROL)
_ESCAPED = re.compile(r"\\(\\?)")
_ESCAPED_ROLE = re.compile(r"\\(n|\\?)")
_MESSAGE = re.compile(re.escape(TURN) + r"([^\n]*)\n(.*)" + re.escape(END), re.S)


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), rf"([<\[])(?={_AFTER})", r"$1\\")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def unescape_role(role: str) -> str:
    return _ESCAPED_ROLE.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def events_from_turns(turns: DataFrame, delta_chars: int = 512) -> DataFrame:
    """Event log of a table of turns (conv_id, turn, role, text): each row
    starts a message and streams its text in deltas. A null text is empty.

    Every row is a message of its own. They are in the order of ``turn``, null
    first; rows with one (conv_id, turn) are ordered by role, null first, then
    by a hash of the text, and rows that are equal follow one another. They are
    told apart by a count with map-side combining, so a turn that very many rows
    repeat needs no group of its own in one task.
    """
    rows = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    message = F.struct("turn", "role", F.md5("text").alias("text"), "copy")
    text = F.col("text")
    n = F.ceil(F.length(text) / F.lit(delta_chars)).cast("int")
    parts = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(i.alias("part"), F.when(i > 0, F.substring(text, (i - 1) * delta_chars + 1, F.lit(delta_chars))).alias("text")))
    return rows.select("conv_id", message.alias("message"), "role", F.explode(parts).alias("p")).select(
        "conv_id",
        "message",
        F.struct(F.col("message"), F.col("p.part")).alias("seq"),
        F.when(F.col("p.part") == 0, "start").otherwise("delta").alias("kind"),
        F.when(F.col("p.part") == 0, F.col("role")).alias("role"),
        F.col("p.text").alias("text"),
    )


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of logs (conv_id,
    message, seq, kind, role, text).

    A message without a role has the role ``""``, a null text adds nothing.
    Events with a null kind or message are ignored; a null conv_id is a
    conversation of its own. Events repeated with the same seq count once.
    """
    ev = events.select("conv_id", "message", "seq", "kind", "role", "text").filter("kind IS NOT NULL AND message IS NOT NULL")
    reset = F.col("kind").isin("edit", "regenerate")
    part = F.struct("seq", F.coalesce("text", F.lit("")).alias("text"), reset.alias("reset"))
    folded = ev.groupBy("conv_id", "message").agg(
        F.max("role").alias("role"),
        F.min("seq").alias("began"),
        F.max(F.when(reset, F.col("seq"))).alias("last_reset"),
        F.array_sort(F.collect_set(F.when(F.col("kind").isin("delta", "edit", "regenerate"), part))).alias("parts"),
    )
    keep = F.filter("parts", lambda p: F.col("last_reset").isNull() | (p["seq"] >= F.col("last_reset")))
    kind_text = F.array_join(F.transform(keep, lambda p: p["text"]), "")
    folded = folded.select("conv_id", "message", F.coalesce("role", F.lit("")).alias("role"), "began", kind_text.alias("text"))
    # a regeneration drops the later messages begun before it
    cuts = ev.filter("kind = 'regenerate'").groupBy("conv_id", "message").agg(F.max("seq").alias("cut")).select(
        F.col("conv_id").alias("_c"), F.col("message").alias("_m"), "cut"
    )
    gone = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_m") < F.col("message")) & (F.col("began") < F.col("cut"))
    return folded.join(cuts, gone, "left_anti").select("conv_id", "message", "role", "text")


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Per message: ``formatted`` (its part of the conversation's text; parts
    in the order of ``message`` are the whole), ``loss_start`` and
    ``loss_length`` (code points of that part under the loss mask)."""
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n"))
    body = escape(F.col("text"))
    counts = F.col("role").isin(*loss_roles)
    head = F.concat(F.lit(TURN), role, F.lit("\n"))
    return messages.select(
        "conv_id",
        "message",
        F.concat(head, body, F.lit(END)).alias("formatted"),
        F.when(counts, F.length(head)).otherwise(0).cast("long").alias("loss_start"),
        F.when(counts, F.length(body)).otherwise(0).cast("long").alias("loss_length"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """Per conversation, from the rendered parts alone: ``n_turns``,
    ``turns_sha256`` (of role, line break, text, line break per turn),
    ``loss_chars``, ``loss_sha256`` (of the unescaped text under the mask, in
    order) and ``formatted_chars``.

    The digests are sequential by nature: a conversation's parts are streamed
    in order through one task, which holds one part at a time.
    """
    conv_type = rendered.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        done: list[tuple] = []

        def finished():
            return (key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for batch in batches:
            for conv, part, start, length in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if state is None or conv != key:
                    if state is not None:
                        done.append(finished())
                    key, state = conv, [0, sha256(), 0, sha256(), 0]
                m = _MESSAGE.fullmatch(part)
                if m is None:
                    raise ValueError(f"conversation {conv}: a part is not in the template")
                state[0] += 1
                state[1].update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
                if length:
                    loss = unescape(part[start : start + length])
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                state[4] += len(part)
            if done:
                yield made(done)
                done = []
        if state is not None:
            yield made([finished()])

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(c) if i else pa.array(c, pa.int64() if conv_type == "bigint" else None) for i, c in enumerate(zip(*rows))], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    rows = clustered(rendered.select("conv_id", "message", "formatted", "loss_start", "loss_length"), ["conv_id"], ["message"])
    return rows.mapInArrow(
        run, f"conv_id {conv_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
