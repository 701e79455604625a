"""Token counts without token ids.

Each task splits its texts into pre-tokens, takes every document's pre-token
frequencies, has the pieces of each distinct pre-token counted once and joins
the counts back to the frequencies. The table of distinct pre-tokens belongs to
the task (at most ``KNOWN`` entries, then it starts anew; a later sighting is
counted again, so results do not depend on it). A table for the whole corpus
would have to meet the per-document frequencies in a shuffle of the size of the
corpus; see the README.

Defined results: a null text counts as empty, an empty text has no tokens; null
IDs and repeated rows are counted like others, one output row per input row.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.llm.common import table, text_or_empty
from tablefit.llm.tokens import piece_counter, vocabulary

KNOWN = 1_000_000
#: Characters of text whose pre-tokens are looked up together.
CHUNK_CHARS = 4 << 20
LIMIT = 512


def token_counts(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens``, one row per input row."""
    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    spec = vocabulary(docs.sparkSession, vocab_path)

    def run(batches):
        import pyarrow as pa

        split, count = piece_counter(spec.value)
        pieces: dict[str, int] = {}

        def totals(freqs):
            new = set().union(*[f.keys() for f, _ in freqs]).difference(pieces)
            if len(pieces) + len(new) > KNOWN:
                pieces.clear()
                new = set().union(*[f.keys() for f, _ in freqs])
            new = list(new)
            pieces.update(zip(new, count(new)))
            return [specials + sum(pieces[w] * n for w, n in f.items()) for f, specials in freqs]

        for b in batches:
            n_bytes, n_tokens, freqs, chars = [], [], [], 0
            for t in b.column(1):
                text = t.as_py()
                words, specials = split(text)
                freqs.append((Counter(words), specials))
                n_bytes.append(len(text.encode("utf-8", "surrogatepass")))
                chars += len(text)
                if chars > CHUNK_CHARS:
                    n_tokens += totals(freqs)
                    freqs, chars = [], 0
            if freqs:
                n_tokens += totals(freqs)
            yield pa.record_batch([b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                                  ["id", "n_bytes", "n_tokens"])

    return src.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long")


def query(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    out = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
