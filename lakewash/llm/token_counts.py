"""Token counts by a digest cache.

A text is known by the SHA-256 of its normalised content, a tokenizer by the
SHA-256 of its library, the library's version and its model. Counts are kept
in a Parquet table, one folder for each tokenizer digest. A run joins the
digests of its documents to that table, encodes one text of each digest that
is missing, appends those counts, and joins again:

1. every text is read once for its digest and size, and those are staged;
2. distinct digests without a stored count are the misses;
3. one text of each miss is kept: copies are reduced inside each task before
   the shuffle, so a text that a third of all rows hold moves once a task. When
   the table already holds counts, a Bloom filter of the misses keeps most
   texts of stored digests from moving; the join decides;
4. the tokenizer encodes them, and the counts are appended in one commit;
5. staged digests are joined to the table.

An append that two runs make at once can store a digest twice; readers take
one row of a digest. A run that fails before its append only loses time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from importlib.metadata import version

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewash.llm import bloom
from lakewash.llm.common import only, staged, table
from lakewash.session import scratch_path
from lakewash.sources.readers import path_exists

#: Tokens that a training sequence holds.
TOKEN_LIMIT = 4096
#: Texts above this many characters are encoded in pieces, where that is exact.
PIECE_CHARS = 1 << 16
#: A model that is sent to the tasks may have this many bytes.
MODEL_BYTES = 256 << 20

CACHE_SCHEMA = "content binary, n_tokens long"


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer's model and all that decides its counts."""

    library: str  # 'sentencepiece' or 'tokenizers'
    model: bytes

    @property
    def digest(self) -> str:
        """Another library, library version or model is another tokenizer."""
        head = f"{self.library}\n{version(self.library)}\n".encode()
        return hashlib.sha256(head + self.model).hexdigest()

    def counter(self) -> Callable[[str], int]:
        """A function from a text to its number of tokens, without begin, end
        or added special tokens."""
        return _sentencepiece(self.model) if self.library == "sentencepiece" else _tokenizers(self.model)


def tokenizer_at(path: str) -> Tokenizer:
    """The tokenizer of a vocabulary file: ``.model`` or ``.json``."""
    library = {"model": "sentencepiece", "json": "tokenizers"}.get(path.rsplit(".", 1)[-1])
    if library is None:
        raise ValueError(f"{path} is neither a .model nor a .json vocabulary")
    with open(path, "rb") as f:
        model = f.read()
    if len(model) > MODEL_BYTES:
        raise ValueError(f"{path} has {len(model)} bytes; a model of up to {MODEL_BYTES} is sent to the tasks")
    return Tokenizer(library, model)


def _sentencepiece(model: bytes) -> Callable[[str], int]:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    # A long text may be cut before a space that follows another character if no
    # entry of the vocabulary spans such a place, every space is kept, and each
    # text begins as if a space stood before it: the space cut away comes back.
    spans = any(re.search("[^▁]▁", sp.id_to_piece(i)) for i in range(sp.get_piece_size()))
    exact = not spans and sp.normalize(" a  b ") == "▁▁a▁▁b▁"
    cut = re.compile("(?<=[^ ▁]) ")

    def pieces(text: str) -> Iterator[str]:
        start = 0
        while exact and len(text) - start > PIECE_CHARS:
            found = cut.search(text, start + PIECE_CHARS)
            if found is None:
                break
            yield text[start:found.start()]
            start = found.end()
        yield text[start:]

    def count(text: str) -> int:
        if len(text) <= PIECE_CHARS:
            return len(sp.encode(text))
        return sum(len(sp.encode(p)) for p in pieces(text))

    return count


def _tokenizers(model: bytes) -> Callable[[str], int]:
    import tokenizers

    tok = tokenizers.Tokenizer.from_str(model.decode())
    tok.no_truncation()
    tok.no_padding()
    return lambda text: len(tok.encode(text, add_special_tokens=False))


def as_written(text: Column) -> Column:
    """The plainest normal form, exact for every tokenizer: null is empty."""
    return F.coalesce(text, F.lit(""))


def stored_counts(spark: SparkSession, cache: str, tokenizer: Tokenizer) -> DataFrame:
    """``(content, n_tokens)`` of a tokenizer, one row for each digest."""
    path = f"{cache.rstrip('/')}/tokenizer={tokenizer.digest}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path).groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))


def _texts_of(texts: DataFrame, misses: DataFrame, n_misses: int, all_missing: bool) -> DataFrame:
    """One text for each missing digest."""
    if not all_missing:
        flags = bloom.build(misses.select(F.xxhash64("content").alias("h")), "h", bloom.bits_for(n_misses))
        texts = bloom.prefilter(texts.withColumn("h", F.xxhash64("content")), "h", flags).drop("h")
    one = texts.groupBy("content").agg(F.first("text").alias("text"))
    # the texts are dealt by digest already; only the misses move for the join
    return one if all_missing else one.join(misses.hint("merge"), "content", "left_semi")


def _encode(texts: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer.counter()
        for batch in batches:
            n = [count(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(n, pa.int64())], ["content", "n_tokens"])

    return texts.mapInArrow(encode, CACHE_SCHEMA)


def token_counts(docs: DataFrame, tokenizer: Tokenizer, cache: str, limit: int = TOKEN_LIMIT,
                 normalise: Callable[[Column], Column] = as_written) -> DataFrame:
    """``(doc_id, content, n_bytes, n_tokens, over_limit)`` for every row.

    ``cache`` is a folder that all executors reach; it is made where it is
    absent. ``normalise`` is a native form that the tokenizer's counts do not
    depend on (lower case, for a tokenizer that lower-cases): it is what is
    digested and encoded, so more texts share a count. ``n_bytes`` is the size
    of the text as given, in UTF-8.

    A null text is an empty one; copies, null and repeated doc_ids and empty
    texts keep their rows; other columns of ``docs`` are left out; an empty
    table gives no row and leaves the cache as it was. A text of any length is
    counted whole: beyond 65,536 characters in pieces where the vocabulary
    makes that exact, else at once, in memory proportional to the text.
    """
    spark = docs.sparkSession
    own = only(docs, "doc_id", "text")
    content = F.unhex(F.sha2(normalise(F.col("text")), 256))
    keyed = staged(own.select("doc_id", content.alias("content"),
                              F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")), "token-keys")
    stored = stored_counts(spark, cache, tokenizer)
    first = stored.isEmpty()
    misses = keyed.select("content").distinct()
    if not first:
        misses = staged(misses.join(stored, "content", "left_anti"), "token-misses")
    n_misses = 0 if first else misses.count()
    if first or n_misses:
        texts = own.select(content.alias("content"), normalise(F.col("text")).alias("text"))
        _encode(_texts_of(texts, misses, n_misses, first), tokenizer).write.mode("append").parquet(
            f"{cache.rstrip('/')}/tokenizer={tokenizer.digest}")
        stored = stored_counts(spark, cache, tokenizer)
    return keyed.join(stored, "content", "left").select(
        "doc_id", F.lower(F.hex("content")).alias("content"), "n_bytes", "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents with a public vocabulary, from an empty
    cache."""
    import public_tokenizers

    tokenizer = tokenizer_at(public_tokenizers.path("piece_bpe_32k.model"))
    counts = token_counts(table(spark, sf_dir, "documents"), tokenizer, scratch_path(spark, "token-cache"))
    return counts.select("doc_id", "n_bytes", "n_tokens", "over_limit")
