"""Documents into containers of a fixed number of tokens, with little unused space.

Each text is measured with a public tokenizer, whose vocabulary file is a parameter. A text longer than the capacity is divided
into full pieces and a remainder; no other text is divided. The pieces are packed by the sum-of-squares rule: with N(g) open
containers that have g tokens left, each piece goes where the sum of N(g) squared becomes smallest, an existing container or a
new one; of equal places the fullest is taken. Full pieces have a container of their own.

The rule looks at one piece after the other, so pieces are spread by a hash into groups of about 10,000 that are packed side by
side; a group never grows with the data, and only identifiers and sizes are shuffled. Each group leaves a few containers open;
what they lack is included in the figures.

Defined results: null texts and null ids are left out; an empty text has no tokens and goes into the first open container; an
id that occurs twice counts once, with its longer text; a table without rows gives no container; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = os.environ.get("QUILLSPARK_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: How text is cut before the merges, as the vocabulary file expects it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CAPACITY = 2048
GROUP = 10_000
#: The largest vocabulary file that is sent to the executors.
MAX_VOCABULARY_BYTES = 32 << 20
PACKED = "doc_id long, piece int, first_token long, n_tokens int, container string"


def token_counter(vocabulary: bytes):  # noqa: ANN201
    """A function from text to its number of tokens."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(own.encode_ordinary(text))


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, n_tokens`` of every text."""
    if os.path.getsize(tokenizer) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{tokenizer} is too large to be sent to the executors")
    with open(tokenizer, "rb") as f:
        sent = documents.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = token_counter(sent.value)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": [count(t) for t in pdf["text"]]})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    return rows.mapInPandas(run, "doc_id long, n_tokens long").groupBy("doc_id").agg(F.max("n_tokens").alias("n_tokens"))


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each piece, by the sum-of-squares rule in the order given."""
    n = np.zeros(capacity + 1, np.int64)  # open containers by tokens left
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), np.int64)
    made = 0
    far = np.iinfo(np.int64).max
    for k, s in enumerate(sizes.tolist()):
        if s == 0:
            some = np.flatnonzero(n)
            if len(some):
                out[k] = open_at[int(some[0])][-1]
                continue
        # Change of the sum: one fewer with g left, one more with g - s (full containers aren't open).
        more = 2 * n[: capacity + 1 - s] + 1
        more[0] = 0
        change = np.where(n[s:] > 0, more - 2 * n[s:] + 1, far)
        at = int(change.argmin())
        if change[at] <= more[capacity - s]:
            g = at + s
            c = open_at[g].pop()
            n[g] -= 1
        else:
            g, c = capacity, made
            made += 1
        out[k] = c
        if g - s:
            open_at[g - s].append(c)
            n[g - s] += 1
    return out


def packed(counts: DataFrame, n_documents: int, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``doc_id, piece, first_token, n_tokens, container`` of every piece."""
    if capacity < 1:
        raise ValueError("the capacity must be positive")
    groups = max(1, -(-n_documents // group))
    pieces = counts.select("doc_id", F.expr(f"explode(sequence(0, cast(greatest(n_tokens - 1, 0) div {capacity} as int)))").alias("piece"), "n_tokens").select(
        "doc_id", "piece", (F.col("piece").cast("long") * capacity).alias("first_token"), F.least(F.col("n_tokens") - F.col("piece").cast("long") * capacity, F.lit(capacity)).cast("int").alias("n_tokens")
    )
    own = F.concat_ws("-", F.lit("whole"), "doc_id", "piece")
    full = pieces.where(F.col("n_tokens") == capacity).withColumn("container", own)
    rest = pieces.where(F.col("n_tokens") < capacity).withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece"])
        at = pack(pdf["n_tokens"].to_numpy(), capacity)
        head = f"mixed-{pdf['bucket'].iloc[0]}-"
        return pdf.assign(container=[head + str(c) for c in at])[["doc_id", "piece", "first_token", "n_tokens", "container"]]

    return full.unionByName(rest.groupBy("bucket").applyInPandas(run, PACKED))


def documents_packed(documents: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    return packed(token_counts(documents, tokenizer), documents.count(), capacity)


def container_fill(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``container, n_pieces, n_tokens, unused``."""
    return pieces.groupBy("container").agg(F.count("*").alias("n_pieces"), F.sum("n_tokens").cast("long").alias("n_tokens")).withColumn("unused", F.lit(capacity) - F.col("n_tokens"))
