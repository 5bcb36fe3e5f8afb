"""What the text operators share: reading tables, checkpoints, tokenizers."""

from __future__ import annotations

import functools
import gc
import json
import time

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed as checkpointed  # for the operators

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def forgotten(df: DataFrame, wait: bool = False) -> None:
    """Lets Spark remove the shuffle files of what was checkpointed and isn't referred to any more.

    It does so when the driver collects its garbage, which a small driver may not do for
    many rounds of a loop. What Python gives up reaches the JVM by a thread that looks once a
    second: loops release it a round later; before a long step, ``wait`` for it.
    """
    gc.collect()
    if wait:
        time.sleep(1.2)
    df.sparkSession.sparkContext._jvm.java.lang.System.gc()


def checkpointed_by(df: DataFrame, parts: int, key: str) -> DataFrame:
    """``df`` dealt by ``key`` and checkpointed; what is grouped by ``key`` later is not dealt again.

    A checkpoint keeps the partitioning that its plan tells, which adaptive plans don't;
    this one has nothing to adapt, so it is planned without.
    """
    conf = df.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return checkpointed(df.repartition(parts, key))
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def id_bucket(doc_id, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(modulus)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# Fixed value: the public byte-level pre-tokenisation pattern.
BYTE_LEVEL_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Encoder and decoder of one byte-level vocabulary file.

    ``encode`` gives what the tokenizers library gives for the same file without
    added special tokens: the file's own special strings in a text become their
    ids, the text between them is encoded by itself.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.specials}
        ranks = {bytes(alphabet[c] for c in t): i for t, i in plain.items()}
        self.core = tiktoken.Encoding("byte_bpe", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=dict(self.specials))
        size = max([*plain.values(), *self.specials.values()]) + 1
        self.pieces = [b""] * size
        for piece, i in [*ranks.items(), *((s.encode(), i) for s, i in self.specials.items())]:
            self.pieces[i] = piece
        self.decimals = [str(i) for i in range(size)]

    def encode(self, text: str) -> np.ndarray:
        """Ids as an unsigned 32-bit array."""
        special = "all" if any(s in text for s in self.specials) else set()
        return np.asarray(self.core.encode_to_numpy(text, allowed_special=special, disallowed_special=()), dtype=np.uint32)

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder for each worker process and file."""
    return ByteBpe(path)
