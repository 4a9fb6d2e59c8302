"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted. A document longer than the largest is cut into pieces of
that length and a rest; every token is placed exactly once. Pieces are dealt by a hash of document
and piece into groups of a few thousand, and each group is packed on its own: pieces in falling
length, each into the open bin that it fits best (least room left). Where none has room, the
permitted lengths are compared: for each, the bin is filled (in thought) with the longest pieces
that are still waiting and fit, and the length with the least cost a placed token is opened.
Finally every bin is downsized to the smallest permitted length that holds its contents.

A bin of ``c`` tokens costs ``c + c * c / ATTENTION + BIN_COST``: what a model does for each token, what
attention does for each pair of them, and what a sequence takes at least. Long bins pay for their
pairs, short ones for their number, and empty places cost as much as filled ones, so the length that
is opened depends on the pieces that wait.

A group holds only ids and lengths, its size does not depend on the corpus, and long documents or
frequent lengths spread over all groups. More groups cost nothing; a few thousand pieces already
fill bins as well as all of them would.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, table, written
from .tokens import encoder as encoder_of

CAPACITIES = (512, 1024, 2048, 4096, 8192)
GROUP_PIECES = 4096
ROWS = 1000  # texts that a task takes at a time
BIN_COST = 16  # of a sequence, in tokens
ATTENTION = 65_536  # length at which attention costs as much as everything else


def cost(capacity: int) -> float:
    return capacity + capacity * capacity / ATTENTION + BIN_COST


def pack_group(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES) -> tuple[list[int], list[int]]:
    """Bin of each piece (lengths fall), and the final capacity of each bin."""
    caps = sorted(capacities)
    top = caps[-1]
    waiting = [0] * (top + 1)
    for n in lengths:
        waiting[n] += 1
    present = 0  # bit n: a piece of n tokens waits
    for n in set(lengths):
        present |= 1 << n
    room: list[list[int]] = [[] for _ in range(top + 1)]
    roomy = 0  # bit r: a bin has r tokens left
    used: list[int] = []
    where: list[int] = []

    def filled(first: int, capacity: int) -> int:
        """Tokens of a new bin that takes the longest waiting pieces while they fit."""
        left, taken = capacity - first, {}
        while left > 0:
            mask = present & ((1 << (left + 1)) - 1)
            while mask:
                n = mask.bit_length() - 1
                have = waiting[n] - taken.get(n, 0)
                if have > 0:
                    break
                mask ^= 1 << n
            else:
                break
            k = min(have, left // n)
            taken[n] = taken.get(n, 0) + k
            left -= k * n
        return capacity - left

    for n in lengths:
        waiting[n] -= 1
        if not waiting[n]:
            present ^= 1 << n
        fits = roomy >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                roomy ^= 1 << r
        else:
            size = min((c for c in caps if c >= n), key=lambda c: (cost(c) / max(1, filled(n, c)), c))
            b, r = len(used), size
            used.append(0)
        used[b] += n
        where.append(b)
        if r - n:
            if not room[r - n]:
                roomy |= 1 << (r - n)
            room[r - n].append(b)
    return where, [caps[bisect_left(caps, max(1, u))] for u in used]


def token_counts(docs: DataFrame, tokenizer: str | None = None, end: int = 1, kept: int | None = None) -> DataFrame:
    """(doc_id, n_tokens): ids of each whole text and ``end`` end marks. A worker's encoder keeps ``kept`` pieces at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer, kept)
        for batch in batches:
            parts = (batch.column("text").slice(at, ROWS).to_pylist() for at in range(0, len(batch), ROWS))
            n = [len(x) + end for part in parts for x in encoder.encode(part)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long")


def pack_lengths(counts: DataFrame, capacities: tuple[int, ...] = CAPACITIES, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``counts(doc_id, n_tokens)`` -> a row for each piece: where in which bin it lies.

    bin_id is ``group * 2**32 + bin``. Rows of one doc_id are packed each on its own. Ties in length
    go by doc_id, then piece. Documents of no tokens take no place and give no row.
    """
    top = max(capacities)
    pieces = counts.filter("n_tokens > 0").select(
        "doc_id", "n_tokens", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_tokens") - 1) / top).cast("int"))).alias("piece")
    )
    pieces = pieces.select(
        "doc_id", "piece", (F.col("piece").cast("long") * top).alias("first_token"),
        F.least(F.lit(top).cast("long"), F.col("n_tokens") - F.col("piece").cast("long") * top).alias("length"),
    )
    total = counts.agg(F.sum(F.ceil(F.col("n_tokens") / top))).first()[0] or 0
    groups = max(1, round(total / group_pieces))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        where, capacity = pack_group(frame["length"].tolist(), capacities)
        bins = np.array(where, np.int64)
        frame["bin_id"] = frame["grp"].to_numpy(np.int64) * (1 << 32) + bins
        frame["bin_tokens"] = np.array(capacity, np.int64)[bins]
        frame["bin_start"] = frame.groupby("bin_id")["length"].cumsum() - frame["length"]
        return frame[["doc_id", "piece", "first_token", "length", "bin_id", "bin_start", "bin_tokens"]]

    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    return dealt.groupBy("grp").applyInPandas(
        run, "doc_id long, piece int, first_token long, length long, bin_id long, bin_start long, bin_tokens long"
    )


def best_fit_packing(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, tokenizer: str | None = None, kept: int | None = None) -> DataFrame:
    """Pack ``docs(doc_id, text)``. A null or empty text is one end mark; extra columns are ignored."""
    counts = written(token_counts(only(docs, doc_id="long", text="string"), tokenizer, kept=kept), "counts")
    return pack_lengths(counts, capacities)


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))


QUERIES = {"op10_best_fit_packing": op10_best_fit_packing}
ORACLE_SQL: dict[str, str] = {}
