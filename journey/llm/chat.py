"""Chat formatting by incremental rendering of a black-box template.

A template is any function from a list of messages (``role``, ``text``) to one
string.  Successive turn prefixes are rendered; where the longer output
starts with the shorter one, the rest is the new turn's piece.  Where it does
not, the template rewrites history and the turn is marked.  Rendering a turn
once more with a marker for its text locates the text inside the piece.

A template may look at anything in the messages, so a conversation's turns
stream in order through one task with the whole history; that takes a
conversation's memory, and two renders of the history for each turn.  Only where
the caller declares how many turns a template looks back over (``looks_back``) are
conversations cut into blocks of at least ``BLOCK`` turns, each with so many turns
and one more before it as history (the shorter prefix looks back too), and one of
any length is rendered by many tasks in bounded memory.

Defined cases
    null text or role: empty.  Turns are ordered by ``turn`` (null first), ties
    by role and text; repeated rows are turns of their own.  A null
    conversation id is a conversation.  Empty table: empty result.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from journey.llm.common import q, slices

# --- fixed values: the chat template's control strings, and the operator's parameters
START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"
BLOCK = 16
#: ``chatml`` renders every turn by itself
CHATML_LOOKS_BACK = 0
MARK = "text"
# ----------------------------------------------------------------------------------------

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    """Reversibly break ``<|``: one back-slash more between the two characters."""
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def chatml(messages: list[dict]) -> str:
    """The production template: every turn between control strings, texts escaped."""
    return "".join(f"{START}{escape_role(m['role'])}\n{escape(m['text'])}{END}" for m in messages)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn in formatted text."""
    return [(unescape_role(r), unescape(t)) for r, t in _TURN.findall(formatted)]


class Renderer:
    """Renders one conversation turn by turn; ``history`` are the turns so far."""

    def __init__(self, render):
        self.render = render
        self.history: list[dict] = []
        self.before: str | None = None

    def skip(self, t: dict) -> None:
        """Take ``t`` as history without a piece of its own."""
        self.history.append(t)
        self.before = None

    def add(self, t: dict) -> dict:
        """The turn's piece, where its text lies in the piece, whether the render rewrote history."""
        before = self.render(list(self.history)) if self.before is None else self.before
        after = self.render([*self.history, t])
        kept = len(before)
        rewrites = not after.startswith(before)
        if rewrites:
            limit = min(len(before), len(after))
            kept = next((i for i in range(limit) if before[i] != after[i]), limit)
        probe = self.render([*self.history, {**t, "text": MARK}])
        at = probe.rfind(MARK)
        start, tail = at, len(probe) - at - len(MARK)
        if at < kept:  # the text does not reach the output, or stands in rewritten history
            start, tail = len(after), 0
        self.history.append(t)
        self.before = after
        return {"piece": after[kept:], "text_start": start - kept, "text_end": max(start, len(after) - tail) - kept,
                "rewrites": rewrites}


def render_block(render, context: list[dict], turns: list[dict]) -> list[dict]:
    """For each turn after ``context``: its piece, where its text lies in the piece, whether the render rewrote history."""
    one = Renderer(render)
    for t in context:
        one.skip(t)
    return [one.add(t) for t in turns]


PIECES = ("pos long, role string, piece string, text_start long, text_end long, trained boolean, rewrites boolean")


def format_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 render=chatml, trained_role: str = TRAINED_ROLE, looks_back: int | None = None) -> DataFrame:
    """One row per turn: ``conv``, position, formatted piece, the text's span in it, loss mask, rewrite mark.

    ``looks_back``: over how many turns before the last ``render`` looks back or rewrites, beyond whether there are any;
    unknown by default, then every turn is rendered with its whole history.

    A conversation's formatted text is its pieces in order; the loss mask
    covers [text_start, text_end) of the pieces with ``trained``.
    """
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = turns.select(q(conv).alias("conv"), q(turn).alias("turn"),
                        F.coalesce(q(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(q(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("pos", (F.row_number().over(order) - 1).cast("long")).drop("turn")
    if looks_back is None:
        rows = rows.select("conv", "pos", "role", "text", F.lit(0).cast("long").alias("block"), F.lit(False).alias("context"))
    else:
        context = looks_back + 1
        block = max(BLOCK, context)
        own = F.struct(F.floor(F.col("pos") / block).cast("long").alias("block"), F.lit(False).alias("context"))
        next_ = F.struct((F.floor(F.col("pos") / block) + 1).cast("long").alias("block"), F.lit(True).alias("context"))
        both = F.when(F.pmod("pos", F.lit(block)) >= block - context, F.array(own, next_)).otherwise(F.array(own))
        rows = rows.select("conv", "pos", "role", "text", F.explode(both).alias("b"))
        rows = rows.select("conv", "pos", "role", "text", "b.*")
    rows = rows.repartition("conv", "block").sortWithinPartitions("conv", "block", "pos")
    ddl = f"conv {rows.schema['conv'].dataType.simpleString()}, {PIECES}"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        key, one = None, None
        for batch in batches:
            for part in slices(batch):
                out = []
                for g in part.to_pylist():
                    if one is None or key != (g["conv"], g["block"]):
                        key, one = (g["conv"], g["block"]), Renderer(render)
                    t = {"role": g["role"], "text": g["text"]}
                    if g["context"]:
                        one.skip(t)
                    else:
                        out.append({"conv": g["conv"], "pos": g["pos"], "role": g["role"],
                                    "trained": g["role"] == trained_role, **one.add(t)})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    return rows.mapInArrow(run, ddl)


DIGEST = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
          "rewrites boolean")


def digest(pieces: DataFrame) -> DataFrame:
    """One row per conversation with digests read back from its pieces.

    A digest is sequential, so a conversation's pieces stream through one
    task in order, with a running hash and no buffer.
    """
    ordered = pieces.repartition("conv").sortWithinPartitions("conv", "pos")
    ddl = f"conv {pieces.schema['conv'].dataType.simpleString()}, {DIGEST}"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        state, out = None, []

        def done():
            n, turns, loss, loss_chars, chars, rewrites = state[1:]
            out.append({"conv": state[0], "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_chars,
                        "loss_sha256": loss.hexdigest(), "formatted_chars": chars, "rewrites": rewrites})

        for batch in batches:
            for part in slices(batch):
                for r in part.to_pylist():
                    if state is None or state[0] != r["conv"]:
                        if state:
                            done()
                        state = [r["conv"], 0, hashlib.sha256(), hashlib.sha256(), 0, 0, False]
                    for role, text in read_back(r["piece"]):
                        state[1] += 1
                        state[2].update(f"{role}\n{text}\n".encode())
                    if r["trained"]:
                        text = unescape(r["piece"][r["text_start"]:r["text_end"]])
                        state[3].update(text.encode())
                        state[4] += len(text)
                    state[5] += len(r["piece"])
                    state[6] |= r["rewrites"]
            if len(out) > 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if state:
            done()
            yield pa.RecordBatch.from_pylist(out, schema)

    return ordered.mapInArrow(run, ddl)
