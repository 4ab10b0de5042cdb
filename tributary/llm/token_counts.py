"""Token counts without token ids: every distinct pre-token is counted once.

A tokenizer cuts a text into pre-tokens and each of these, on its own, into pieces. So the
number of tokens of a text is the sum over its distinct pre-tokens of their frequency there
times their number of pieces. All distinct pre-tokens of the table are gathered, the
tokenizer counts the pieces of each once, and the counts are joined to the pre-token
frequencies of the documents and added up.

The join is split by frequency. The most frequent pre-tokens, ``HEAD`` at most, make up nearly
all of a text; they go to every task as a table of bounded size and are added up on the spot;
they include every pre-token that could make a partition of a shuffle hot. The frequencies
of all others, a few for each text, are joined by a shuffle.

A piece that holds a special token of the tokenizer is one pre-token here, and the tokenizer
is asked for all of it.

Defined results: a null or empty text has no tokens; repeated rows are counted one by one; an
empty table gives an empty result. Columns beside the ones named are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import count

import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.tables import batches, pick, stored
from tributary.llm.words import Memory, Words, words

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Pre-tokens that every task gets.
HEAD = 150_000
#: Distinct pieces that a task gathers before it hands them on.
GATHER = 300_000
#: Stands before a piece with special tokens; pre-tokens themselves hold no space.
_SPECIAL = " "


def _pretokens(of: Words, piece: bytes) -> list[str]:
    text = piece.decode()
    return [_SPECIAL + text] if of.has_special(text) else of.pretokens(text)


def vocabulary(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(pretoken, frequency, pieces) of each distinct pre-token of all texts."""

    def gather(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = words(tokenizer)
        seen: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            found: Counter[str] = Counter()
            for piece, n in seen.items():
                for pretoken in _pretokens(of, piece):
                    found[pretoken] += n
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
                ["pretoken", "frequency"],
            )

        for part in parts:
            for text in part.column("text"):
                seen.update((text.as_py() or "").encode().split())
                if len(seen) >= GATHER:
                    yield rows()
        yield rows()

    def pieces(part: pa.RecordBatch) -> pa.RecordBatch:
        of = words(tokenizer)
        counted = [
            of.count_special(x[1:]) if x.startswith(_SPECIAL) else of.count(x)
            for x in part.column("pretoken").to_pylist()
        ]
        return pa.RecordBatch.from_arrays(
            [*part.columns, pa.array(counted, pa.int64())], ["pretoken", "frequency", "pieces"]
        )

    distinct = (
        pick(docs, text="string")
        .mapInArrow(gather, "pretoken string, frequency bigint")
        .groupBy("pretoken")
        .agg(F.sum("frequency").alias("frequency"))
    )
    return batches(distinct, pieces, "pretoken string, frequency bigint, pieces bigint")


def frequencies(
    docs: DataFrame, head: dict[str, int], tokenizer: str = TOKENIZER
) -> DataFrame:
    """(key, doc_id, n_bytes, pretoken, n): for each document a row without pre-token, where
    ``n`` is the number of tokens that ``head`` accounts for, and a row for each distinct
    pre-token beyond, where ``n`` is its frequency."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = words(tokenizer)
        key = count(TaskContext.get().partitionId() << 33)

        def split(piece: bytes) -> tuple[int, tuple[str, ...]]:
            own = _pretokens(of, piece)
            return sum(head.get(x, 0) for x in own), tuple(x for x in own if x not in head)

        known = Memory(split, 200_000)
        for part in parts:
            for at in range(0, part.num_rows, 500):
                some = part.slice(at, 500)
                columns: list[list] = [[], [], [], [], []]
                for doc_id, text in zip(
                    some.column("doc_id").to_pylist(), some.column("text"), strict=True
                ):
                    raw = (text.as_py() or "").encode()
                    tokens, rest = 0, Counter()
                    for piece, n in Counter(raw.split()).items():
                        inside, beyond = known[piece]
                        tokens += n * inside
                        for pretoken in beyond:
                            rest[pretoken] += n
                    row = next(key)
                    size = 1 + len(rest)
                    columns[0] += [row] * size
                    columns[1] += [doc_id] * size
                    columns[2] += [len(raw)] * size
                    columns[3] += [None, *rest]
                    columns[4] += [tokens, *rest.values()]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    ["key", "doc_id", "n_bytes", "pretoken", "n"],
                )

    return pick(docs, doc_id="bigint", text="string").mapInArrow(
        run, "key bigint, doc_id bigint, n_bytes bigint, pretoken string, n bigint"
    )


def frequent(known: DataFrame, most: int) -> DataFrame:
    """(pretoken, pieces) of the most frequent pre-tokens, at most ``most``.

    Pre-tokens are counted by classes of frequency, eight to each doubling, and as many classes
    are taken from the top as fit. So the rows returned are all that leaves the tasks.
    """
    level = F.floor(F.log2(F.col("frequency").cast("double")) * 8)
    classes = known.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()
    least, total = None, 0
    for row in sorted(classes, key=lambda row: -row.level):
        total += row.n
        if total > most:
            break
        least = row.level
    chosen = known.where(level >= least) if least is not None else known.limit(0)
    return chosen.select("pretoken", "pieces")


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, head: int = HEAD) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of each document."""
    known = stored(vocabulary(docs, tokenizer), "vocabulary")
    table = {row.pretoken: row.pieces for row in frequent(known, head).collect()}
    found = stored(frequencies(docs, table, tokenizer), "frequencies")
    rest = (
        found.where("pretoken is not null")
        .join(known, "pretoken")
        .groupBy("key")
        .agg(F.sum(F.col("n") * F.col("pieces")).alias("rest"))
    )
    return (
        found.where("pretoken is null")
        .join(rest, "key", "left")
        .select("doc_id", "n_bytes", (F.col("n") + F.coalesce("rest", F.lit(0))).alias("n_tokens"))
    )
