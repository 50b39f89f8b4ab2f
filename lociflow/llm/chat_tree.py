"""Chat formatting as a prefix tree: shared first turns are written once.

Conversations that begin with the same turns share the nodes of those turns.
Nodes are written depth-first into one stream of token ids; each carries its
start in the stream, the position id of its first token (the tokens of its
ancestors come before it), the stream intervals of its ancestors, which are all
that its tokens may attend to besides themselves, and the interval of its tokens
under the loss mask (the text of an assistant's turn).

A node is named by its path: for each turn from the root on, a hash of that
turn and all before it.  Paths in order of text are the tree in depth-first order, so
the stream is a range sort; what crosses from one range to the next is one
total and the ancestors of one node.  A first turn shared by many conversations
is merged before the shuffle, and its tree may span any number of ranges.

The template writes ``<|role|>``, a line end, the text, ``<|end|>`` and a line end.
Control strings inside roles and texts (`CONTROL`) get a backslash after their
first character, and backslashes are doubled, which `unescape` undoes.

Nulls: a null text or role is an empty one; rows without conversation id make
one conversation.  Turns are ordered by number (missing first), then role, then
text; repeated rows are repeated turns.  An empty table gives an empty stream.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm import byte_bpe
from lociflow.llm.common import batches, column, slices, written
from lociflow.scale import settle

CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
STEP = 24
LEARNT_ROLE = "assistant"
# a backslash, or a character that a control string begins with; such strings may overlap
_ESCAPED = re.compile(r"\\|(?=" + "|".join(map(re.escape, CONTROL)) + ").")
_TURN = re.compile(r"<\|(.*?)\|>\n(.*?)<\|end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def paths(turns: list[tuple[str, str]]) -> list[str]:
    """The path of every turn of a conversation."""
    out, chain, path = [], b"", ""
    for role, text in turns:
        r, t = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
        chain = hashlib.sha256(b"%s%d:%s%s" % (chain, len(r), r, t)).digest()
        path += chain.hex()[:STEP]
        out.append(path)
    return out


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


_NODES = pa.schema([("path", pa.string()), ("role", pa.string()), ("text", pa.string())])
_STREAM = (
    "path string, start long, n_tokens long, position long, loss_from long, loss_to long, "
    "ancestors array<struct<start:long,end:long>>, ids binary"
)


def _turns(convs: DataFrame) -> DataFrame:
    """(path, role, text) of every turn of every conversation, so one for each node and conversation."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            found = (
                (path, t["role"], t["text"])
                for turns in column(part, "turns")
                for path, t in zip(paths([(t["role"], t["text"]) for t in turns]), turns, strict=True)
            )
            yield from batches(found, _NODES)

    return convs.select("turns").mapInArrow(run, "path string, role string, text string")


def leaves(convs: DataFrame) -> DataFrame:
    """(conv_id, path): the last node of each conversation."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            last = [paths([(t["role"], t["text"]) for t in turns])[-1] for turns in column(part, "turns")]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(last, pa.string())], ["conv_id", "path"])

    kind = convs.schema["conv_id"].dataType.simpleString()
    return convs.select("conv_id", "turns").mapInArrow(run, f"conv_id {kind}, path string")


def _tokens(nodes: DataFrame, vocabulary: str) -> DataFrame:
    """Format and encode the nodes: (path, ids, loss_from, loss_to)."""
    schema = pa.schema([("path", pa.string()), ("ids", pa.binary()), ("loss_from", pa.int64()), ("loss_to", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_bpe.codec(vocabulary, public_tokenizers.PATTERN)

        def made(path: str, role: str, text: str) -> tuple:
            head = codec.encode(f"<|{escape(role)}|>\n")
            body = codec.encode(escape(text))
            ids = np.array([*head, *body, *codec.encode("<|end|>\n")], "<u4").tobytes()
            learnt = role == LEARNT_ROLE
            return path, ids, len(head) if learnt else 0, len(head) + len(body) if learnt else 0

        for part in slices(parts):
            yield from batches(map(made, *(column(part, c) for c in ("path", "role", "text"))), schema, 512)

    return nodes.select("path", "role", "text").mapInArrow(run, "path string, ids binary, loss_from long, loss_to long")


def _open(stack: list[tuple[str, int, int]], path: str) -> list[tuple[str, int, int]]:
    """What of a stack of (path, start, end) are ancestors of ``path``."""
    while stack and not path.startswith(stack[-1][0]):
        stack.pop()
    return stack


def _ends(nodes: DataFrame) -> DataFrame:
    """For each range: its tokens and the last node's own and ancestors' places in the range."""
    kind = "part int, total long, last string, paths array<string>, starts array<long>, ends array<long>"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, int, int]] = []
        total = 0
        for part in slices(parts):
            for path, ids in zip(column(part, "path"), part.column(part.schema.get_field_index("ids")), strict=True):
                n = len(ids.as_buffer()) // 4
                _open(stack, path).append((path, total, total + n))
                total += n
        if stack:
            row = (TaskContext.get().partitionId(), total, stack[-1][0], *map(list, zip(*stack, strict=True)))
            schema = pa.schema([("part", pa.int32()), ("total", pa.int64()), ("last", pa.string()), ("paths", pa.list_(pa.string())), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])
            yield from batches([row], schema)

    return nodes.mapInArrow(run, kind)


def stream(convs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The nodes of the prefix tree of (conv_id, turns) as one token stream, depth-first by ``start``."""
    vocabulary = vocabulary or public_tokenizers.path(byte_bpe.VOCABULARY)
    turns = _turns(convs)
    nodes = turns.groupBy("path").agg(F.min(F.struct("role", "text")).alias("turn")).select("path", "turn.*")
    # ranges are cut from the nodes, so that each of them is encoded once
    coded = settle(_tokens(nodes.repartitionByRange("path").sortWithinPartitions("path"), vocabulary))
    # one row a range: where its stream begins, and which nodes of earlier ranges are still open there
    before: dict[int, tuple[int, list[tuple[str, int, int]]]] = {}
    base, carried = 0, []
    for r in sorted(_ends(coded).collect(), key=lambda r: r["part"]):
        before[r["part"]] = (base, carried)
        own = [(p, base + s, base + e) for p, s, e in zip(r["paths"], r["starts"], r["ends"], strict=True)]
        carried = [*_open(list(carried), own[0][0]), *own]
        base += r["total"]
    sent = convs.sparkSession.sparkContext.broadcast(before)
    place = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([
        ("path", pa.string()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("position", pa.int64()),
        ("loss_from", pa.int64()), ("loss_to", pa.int64()), ("ancestors", pa.list_(place)), ("ids", pa.binary()),
    ])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, stack = sent.value.get(TaskContext.get().partitionId(), (0, []))
        stack = list(stack)

        def made(path: str, ids: bytes, loss_from: int, loss_to: int) -> tuple:
            nonlocal at
            n = len(ids) // 4
            above = [{"start": s, "end": e} for _, s, e in _open(stack, path)]
            row = path, at, n, sum(a["end"] - a["start"] for a in above), loss_from, loss_to, above, ids
            stack.append((path, at, at + n))
            at += n
            return row

        for part in slices(parts):
            yield from batches(map(made, *(column(part, c) for c in ("path", "ids", "loss_from", "loss_to"))), schema, 512)

    return coded.mapInArrow(run, _STREAM)


def read_back(tree: DataFrame, last: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """What each conversation says, read from the stream by its last node's attention intervals.

    Every distinct last node is read once; conversations that end there share the result.
    """
    vocabulary = vocabulary or public_tokenizers.path(byte_bpe.VOCABULARY)
    ends = last.select("path").distinct().join(tree.select("path", "start", "ancestors"), "path")
    seen = ends.select("path", F.explode(F.concat(F.col("ancestors.start"), F.array("start"))).alias("start"))
    parts = seen.join(tree.select("start", "loss_from", "loss_to", "ids"), "start")
    whole = parts.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("start", "loss_from", "loss_to", "ids"))).alias("nodes"))
    schema = pa.schema([
        ("path", pa.string()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_bpe.codec(vocabulary, public_tokenizers.PATTERN)

        def text_of(ids: np.ndarray) -> str:
            return codec.decode(ids.tolist()).decode("utf-8", "surrogatepass")

        def made(path: str, nodes: list[dict]) -> tuple:
            whole, learnt = [], []
            for node in nodes:
                ids = np.frombuffer(node["ids"], "<u4")
                whole.append(text_of(ids))
                learnt.append(unescape(text_of(ids[node["loss_from"] : node["loss_to"]])))
            formatted, loss = "".join(whole), "".join(learnt)
            turns = [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]
            said = "".join(f"{r}\n{t}\n" for r, t in turns)
            return path, len(turns), _sha(said), len(loss), _sha(loss), len(formatted)

        for part in slices(batches_):
            yield from batches(map(made, column(part, "path"), column(part, "nodes")), schema)

    read = whole.mapInArrow(run, "path string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return last.join(read, "path").drop("path")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def format_and_read(rows: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write the conversations (conv_id, turn, role, text) as a stream, and read each one back."""
    convs = written(conversations(rows), "conversations")
    tree = written(stream(convs, vocabulary), "chat-tree")
    return read_back(tree, leaves(convs), vocabulary)
