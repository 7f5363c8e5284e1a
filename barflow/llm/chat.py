"""Chat formatting by incremental rendering of a black-box template.

A template is any function from a list of turns to a string. Successive
prefixes of a conversation are rendered; where a turn's output begins and ends
shows by comparing consecutive outputs, and a template that changes what it
wrote before is detected. Where the text of a turn lies in its span shows by
rendering the same prefix with two short texts in its place.

Long conversations are rendered in blocks of turns that overlap, so no task
holds one whole; turns in the overlap are rendered twice and must agree. What a
block can't show, a template that changes its mind only after more turns than one
has, shows by a last rendering of the whole conversation (:func:`against_whole`).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barflow.llm.common import ARROW

#: Turns of one block, and turns before it that are rendered again.
BLOCK, OVERLAP = 16, 2
#: The largest conversation, in code points of its texts and turns of it, that one task renders whole.
WHOLE_CHARS, WHOLE_TURNS = 1 << 24, 1 << 17
Turn = tuple[str, str]
HEAD, TAIL = "### ", "</turn>\n"
_CONTROL = re.compile(r"\\|###|</turn>")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|n)")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def markdown_turns(turns: list[Turn]) -> str:
    """The default template: a head line with the role, the text, an end mark.
    Control strings in texts, and line breaks in roles, follow a backslash."""
    return "".join(f"{HEAD}{escape(role).replace(chr(10), chr(92) + 'n')}:\n{escape(text)}{TAIL}" for role, text in turns)


def parse(piece: str) -> Turn:
    """The turn of one formatted piece."""
    role, _, text = piece.removeprefix(HEAD).removesuffix(TAIL).partition(":\n")
    return unescape(role), unescape(text)


def spans(render: Callable[[list[Turn]], str], turns: list[Turn], trained: str = "assistant"):
    """Per turn: its piece, the start and stop of its text in the piece if its
    role is ``trained``, and whether the template rewrote what stood before."""
    before, out = render([]), []
    for i, (role, text) in enumerate(turns):
        now = render(turns[:i + 1])
        rewrites = not now.startswith(before)
        at = len(commonprefix([before, now])) if rewrites else len(before)
        start = stop = None
        if role == trained and not rewrites:
            # the text stands where two probes differ, and what follows a probe of one character follows it
            a, b = (render(turns[:i] + [(role, probe)]) for probe in "ab")
            start = len(commonprefix([a, b])) - at
            stop = len(now) - at - (len(a) - at - start - 1)
        out.append((now[at:], start, stop, rewrites))
        before = now
    return out


_PIECES = "conv_id long, place long, formatted string, loss_start long, loss_stop long, rewrites boolean, core boolean"


def _render_block(render, trained: str):
    def run(key, table):
        t = table.sort_by("place").to_pydict()
        found = spans(render, list(zip(t["role"], t["text"])), trained)
        cols = list(zip(*found))
        return pa.table({"conv_id": pa.array(t["conv_id"], pa.int64()), "place": pa.array(t["place"], pa.int64()),
                         "formatted": pa.array(cols[0], pa.string()), "loss_start": pa.array(cols[1], pa.int64()),
                         "loss_stop": pa.array(cols[2], pa.int64()), "rewrites": pa.array(cols[3], pa.bool_()),
                         "core": pa.array([p // BLOCK == b for p, b in zip(t["place"], t["block"])], pa.bool_())})
    return run


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, role, text``; a turn's place in its conversation counts from 0."""
    for key, value in ARROW.items():
        conversations.sparkSession.conf.set(key, value)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.withColumn("place", (F.row_number().over(order) - 1).cast("long")).drop("turn")


def format_turns(conversations: DataFrame, render: Callable[[list[Turn]], str] = markdown_turns,
                 trained: str = "assistant") -> DataFrame:
    """One row per turn: ``conv_id``, ``place`` (from 0), ``formatted``, the loss
    mask ``loss_start``/``loss_stop`` in it (null unless the role is
    ``trained``), ``rewrites`` and ``core``.

    The formatted conversation is its core pieces in order. A row with
    ``rewrites`` tells of a template that changed earlier output; rows with
    ``core`` false are second renderings of a block's overlap, kept so that
    :func:`unstable` can compare them.

    Turns are ordered by ``turn``, then role and text. Null roles and texts are
    empty; a null ``conv_id`` is a conversation of its own; repeated rows are
    turns each; an empty table gives no rows; other columns are ignored."""
    rows = _turns(conversations)
    home = F.floor(F.col("place") / BLOCK)
    last = F.when(F.col("place") % BLOCK >= BLOCK - OVERLAP, home + 1)
    blocks = rows.withColumn("block", F.explode(F.array_compact(F.array(home, last))))
    return blocks.groupBy("conv_id", "block").applyInArrow(_render_block(render, trained), _PIECES)


def unstable(pieces: DataFrame) -> DataFrame:
    """Turns that show that the template isn't safe to render piece by piece:
    it rewrote history, or a turn came out otherwise with fewer turns before it.
    The first turn of an overlap has none before it and isn't compared. Blocks
    show what happens within their turns; :func:`against_whole` shows the rest."""
    again = pieces.filter(f"NOT core AND place % {BLOCK} > {BLOCK - OVERLAP}").select(
        F.col("conv_id").alias("c"), F.col("place").alias("p"), F.col("formatted").alias("other"))
    first = pieces.filter("core")
    changed = first.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("place") == F.col("p"))).filter(
        "formatted <> other").select("conv_id", "place")
    return pieces.filter("rewrites AND core").select("conv_id", "place").unionByName(changed).distinct()


_WHOLE = "conv_id long, whole string"


def _render_whole(render):
    def run(key, table):
        t = table.sort_by("place").to_pydict()
        text = render(list(zip(t["role"], t["text"])))
        return pa.table({"conv_id": pa.array(t["conv_id"][:1], pa.int64()), "whole": [_sha256([text])]})
    return run


def _sha256(pieces) -> str:
    h = hashlib.sha256()
    for x in pieces:
        h.update(x.encode("utf-8", "surrogatepass"))
    return h.hexdigest()


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each conversation's pieces in order, one piece at a time."""
    key, h = None, None
    for batch in batches:
        done = []
        for conv, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if h is None or conv != key:
                if h is not None:
                    done.append((key, h.hexdigest()))
                key, h = conv, hashlib.sha256()
            h.update(piece.encode("utf-8", "surrogatepass"))
        if done:
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*done), (pa.int64(), pa.string()))], names=["c", "joined"])
    if h is not None:
        yield pa.record_batch([pa.array([key], pa.int64()), pa.array([h.hexdigest()])], names=["c", "joined"])


def against_whole(conversations: DataFrame, pieces: DataFrame, render: Callable[[list[Turn]], str] = markdown_turns,
                  most_chars: int = WHOLE_CHARS, most_turns: int = WHOLE_TURNS) -> DataFrame:
    """``(conv_id, n_turns, same)``, one row per conversation: whether the template's output
    for the whole conversation is the core pieces in order, so that a template
    that rewrites or looks back over any number of turns is found.

    One task renders a conversation whole, so ``same`` is null where it has more than
    ``most_chars`` code points of text or ``most_turns`` turns: there the template's
    look-back has to be known to be at most ``OVERLAP`` turns. Rows are read as in
    :func:`format_turns`, whose result for the same rows is ``pieces``."""
    rows = _turns(conversations)
    sizes = conversations.groupBy(F.col("conv_id").cast("long").alias("s")).agg(
        F.count(F.lit(1)).alias("n_turns"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"))
    small = sizes.filter((F.col("chars") <= most_chars) & (F.col("n_turns") <= most_turns))
    whole = rows.join(small, F.col("conv_id").eqNullSafe(F.col("s")), "left_semi").groupBy("conv_id").applyInArrow(
        _render_whole(render), _WHOLE)
    core = pieces.filter("core").select("conv_id", "place", "formatted")
    joined = (core.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "formatted")
              .mapInArrow(_join_pieces, "c long, joined string"))
    both = whole.join(joined, F.col("conv_id").eqNullSafe(F.col("c"))).select("conv_id", (F.col("whole") == F.col("joined")).alias("same"))
    return sizes.join(both, F.col("conv_id").eqNullSafe(F.col("s")), "left").select(F.col("s").alias("conv_id"), "n_turns", "same")


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads pieces in order; holds one piece and two running hashes."""
    key, state = object(), None

    def rows(states):
        cols = list(zip(*[(k, n, a.hexdigest(), c, b.hexdigest(), m) for k, n, a, c, b, m in states]))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)], names=[x.split()[0] for x in _DIGEST.split(", ")])
    for batch in batches:
        done = []
        for conv, piece, start, stop in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if state is None or conv != key:
                if state:
                    done.append(state)
                key, state = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse(piece)
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if start is not None:
                masked = unescape(piece[start:stop])
                state[3] += len(masked)
                state[4].update(masked.encode("utf-8", "surrogatepass"))
            state[5] += len(piece)
        if done:
            yield rows(done)
    if state:
        yield rows([state])


def digest(pieces: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted pieces: the turns, the text
    under the loss mask and the size. Hashes run over a conversation in order,
    so each is read by one task, piece by piece."""
    rows = pieces.filter("core").select("conv_id", "place", "formatted", "loss_start", "loss_stop")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return rows.select("conv_id", "formatted", "loss_start", "loss_stop").mapInArrow(_digest, _DIGEST)
