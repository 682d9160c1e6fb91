"""Byte-level BPE over the distinct words of the whole collection.

Texts are cut into pre-tokens.  A block of consecutive documents keeps its pre-tokens in order as small numbers
into the block's own list of distinct words (one byte for the frequent ones).  The words of all blocks are
exploded with their place in the list, in parts by a hash of the word, and shuffled by part: equal words meet,
each distinct word is encoded once, its ids go back to every block that has it, and the blocks are put together
again by position.  Only distinct words per block and their ids move; the packed numbers are written once, in
buckets by block, so they meet the ids without a shuffle.  Decoding joins the token-byte table, whose size is the
vocabulary's.

The blocks are written once to the shared folder, so a task that runs again reads the same blocks.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, in_buckets, tune

# A block ends at this many characters, or one document.
BLOCK_CHARS = 6_000_000
BLOCK_DOCS = 4000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from a rank file (base64 and number per line); read on the driver and broadcast."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def pack(places: np.ndarray) -> bytes:
    """Numbers as bytes: one each; 255 says that the number is the next of those that follow at the end, three bytes each (four if one needs them)."""
    wide = places[places >= 255]
    if not len(wide):
        return places.astype(np.uint8).tobytes()
    width = 3 if wide.max() < 1 << 24 else 4
    return np.minimum(places, 255).astype(np.uint8).tobytes() + wide.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def unpack(data: bytes, n: int) -> np.ndarray:
    """The inverse of ``pack`` for ``n`` numbers."""
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    wide = np.flatnonzero(out == 255)
    if len(wide):
        parts = np.frombuffer(data, np.uint8, len(data) - n, n).reshape(len(wide), -1).astype(np.int64)
        out[wide] = sum(parts[:, i] << 8 * i for i in range(parts.shape[1]))
    return out


def squeeze(*arrays: np.ndarray, data: bytes = b"") -> bytes:
    return zstandard.compress(b"".join(a.astype("<u4").tobytes() for a in arrays) + data)


def _blocks(pattern: str, parts: int, block_chars: int):
    """One row per block: its documents with their packed pre-tokens, and its distinct words by part, most frequent first."""

    def made(docs: list, texts: list[np.ndarray], place: dict) -> pd.DataFrame:
        order = np.argsort(-np.bincount(np.concatenate(texts), minlength=len(place)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        words = [w.encode("utf-8", "surrogatepass") for w in place]
        words = [words[i] for i in order.tolist()]
        packed = [pack(rank[t]) for t in texts]
        home = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(parts)
        rows, by_part = [], np.argsort(home, kind="stable")
        edges = np.flatnonzero(np.diff(home[by_part])) + 1
        for ranks in np.split(by_part, edges) if len(words) else []:
            own = [words[i] for i in ranks.tolist()]
            rows.append({"part": int(home[ranks[0]]), "n": len(own), "words": squeeze(np.array([len(w) for w in own]), data=b"".join(own))})
        whole = squeeze(data=b"".join(packed))
        name = hashlib.blake2b(repr(docs).encode() + whole + b"".join(r["words"] for r in rows), digest_size=8)
        return pd.DataFrame([{
            "block": int.from_bytes(name.digest(), "little", signed=True), "docs": docs, "lengths": [len(t) for t in texts], "sizes": [len(p) for p in packed],
            "packed": whole, "home": squeeze(home), "parts": rows,
        }])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut = regex.compile(pattern).findall
        docs, texts, size, place = [], [], 0, defaultdict(itertools.count().__next__)
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                words = cut(text or "")
                docs.append(doc)
                texts.append(np.fromiter(map(place.__getitem__, words), np.int32, len(words)))
                size += len(text or "")
                if size >= block_chars or len(docs) >= BLOCK_DOCS:
                    yield made(docs, texts, place)
                    docs, texts, size, place = [], [], 0, defaultdict(itertools.count().__next__)
        if docs:
            yield made(docs, texts, place)

    return run


def _encoded(ranks, pattern: str):
    """The ids of a part's words for every block that has some: each distinct word of the part is encoded once.

    Rows come sorted by part; what is remembered of a part is forgotten at the next.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})._encode_single_piece
        now, known = None, {}
        for batch in batches:
            out = []
            for block, part, n, data in zip(batch["home"], batch["part"], batch["n"], batch["words"]):
                if part != now:
                    now, known = part, {}
                raw = zstandard.decompress(data)
                ends = np.cumsum(np.frombuffer(raw, "<u4", n)) + 4 * n
                ids = []
                for start, end in itertools.pairwise([4 * n, *ends.tolist()]):
                    word = raw[start:end]
                    if word not in known:
                        known[word] = piece(word)
                    ids.append(known[word])
                out.append((block, part, n, squeeze(np.array([len(i) for i in ids]), np.array(list(itertools.chain.from_iterable(ids))))))
            yield pd.DataFrame(out, columns=["home", "part", "n", "ids"])

    return run


def _groups(home: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Distinct values and, for each, where it stands."""
    order = np.argsort(home, kind="stable")
    if not len(order):
        return [], []
    groups = np.split(order, np.flatnonzero(np.diff(home[order])) + 1)
    return [int(home[g[0]]) for g in groups], groups


def _assembled(digest: bool, token_bytes):
    """A block's ids from its packed places and the ids of its words; decoded by the token-byte table."""

    def run(blocks: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        out = []
        table = token_bytes.value
        home = np.frombuffer(zstandard.decompress(blocks["home"].iloc[0]), "<u4")
        ids: list[bytes] = [b""] * len(home)
        # Places of a part's words in the block's list, in the order in which the part has them.
        places = dict(zip(*_groups(home)))
        # Blocks of one name are copies of each other, so their words are too.
        for part, n, data in zip(words["part"], words["n"], words["ids"]):
            raw = np.frombuffer(zstandard.decompress(data), "<u4")
            for place, own in zip(places[part].tolist(), np.split(raw[n:], np.cumsum(raw[:n])[:-1])):
                ids[place] = own.tobytes()
        if digest:
            tokens = [np.frombuffer(x, "<u4").tolist() for x in ids]
            counts = np.array([len(t) for t in tokens], np.int64)
            said = [",".join(map(str, t)) for t in tokens]
            bytes_of = [b"".join([table[i] for i in t]) for t in tokens]
        for docs, lengths, sizes, packed in zip(blocks["docs"], blocks["lengths"], blocks["sizes"], blocks["packed"]):
            whole, end = zstandard.decompress(packed), 0
            for doc, n, size in zip(docs, lengths, sizes):
                data = whole[end : end + size]
                end += size
                at = unpack(data, n)
                row = at.tolist()
                if digest:
                    shown = ",".join(map(said.__getitem__, row)).encode()
                    decoded = b"".join(map(bytes_of.__getitem__, row))
                    out.append((doc, int(counts[at].sum()) if n else 0, hashlib.sha256(shown).hexdigest(), hashlib.sha256(decoded).hexdigest()))
                else:
                    out.append((doc, np.frombuffer(b"".join(map(ids.__getitem__, row)), "<u4").astype(np.int32)))
        return pd.DataFrame(out, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["doc_id", "ids"])

    return run


def _run(df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str, text_col: str, digest: bool, block_chars: int) -> DataFrame:
    spark = df.sparkSession
    tune(spark)
    # Ids travel as text: exact, and null where null.
    docs = df.select(column(id_col).cast("string").alias("doc_id"), column(text_col).alias("text"))
    # As many parts as blocks: a part has about as many words as a block.
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-chars // block_chars))
    shape = "block bigint, docs array<string>, lengths array<bigint>, sizes array<bigint>, packed binary, home binary, parts array<struct<part: bigint, n: bigint, words: binary>>"
    blocks = in_buckets(docs.mapInPandas(_blocks(pattern, parts, block_chars), shape), "block", "blocks")
    sent = spark.sparkContext.broadcast(ranks)
    table = spark.sparkContext.broadcast({i: token for token, i in ranks.items()})
    placed = blocks.select(F.col("block").alias("home"), F.explode("parts").alias("p")).select("home", "p.*")
    encoded = placed.repartition("part").sortWithinPartitions("part").mapInPandas(_encoded(sent, pattern), "home bigint, part bigint, n bigint, ids binary")
    out = "doc_id string, n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digest else "doc_id string, ids array<int>"
    whole = blocks.drop("parts").groupBy("block").cogroup(encoded.groupBy("home")).applyInPandas(_assembled(digest, table), out)
    return whole.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, ids`` per row of ``df``: the token ids of the whole text, each match of ``pattern`` encoded by itself.

    Null and empty texts give an empty list; repeated rows and null ids each keep their row; only the two columns
    named are read.  Smaller blocks need less memory per task and shuffle more words.  The vocabulary must hold all 256 single bytes, as byte-level ones do.
    """
    return _run(df, ranks, pattern, id_col, text_col, digest=False, block_chars=block_chars)


def encode_digest(df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """As ``encode``, then decoded: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    The digests are of the decimal ids joined by commas and of the decoded bytes; an empty text has the digests of
    the empty string.
    """
    return _run(df, ranks, pattern, id_col, text_col, digest=True, block_chars=block_chars)


def decode(df: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``, joining the token-byte table (bounded by the vocabulary).

    Ids without a token are an error; bytes that are no UTF-8 become U+FFFD; a null list decodes to null.
    """
    table = df.sparkSession.sparkContext.broadcast({i: token for token, i in ranks.items()})

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = table.value
        for batch in batches:
            yield pd.Series([None if ids is None else b"".join([tokens[i] for i in ids.tolist()]).decode("utf-8", "replace") for ids in batch], dtype=object)

    return df.select(column(id_col).cast("bigint").alias("doc_id"), F.pandas_udf(run, "string")(column(ids_col)).alias("text"))
