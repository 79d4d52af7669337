"""Token counts of whole texts; huge texts by overlapping chunks that are spliced where both agree."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.tokens import load_tokenizer

#: The blanks before which a byte-level BPE pre-tokenizer always cuts after any other character.
BLANKS = " \n"
#: Characters that some definition calls white space; a boundary never follows one.
SPACES = set(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def stable(text: str, at: int) -> bool:
    """Whether no token of a byte-level pre-tokenizer can span position ``at``, whatever stands around.

    All its patterns match either white space or, after one optional space, characters
    that are none; so a cut falls between a character and a blank that follows it.
    """
    return 0 < at < len(text) and text[at] in BLANKS and text[at - 1] not in SPACES


def chunked_ids(encode, text: str, chunk: int, overlap: int) -> list[int]:
    """Ids of a text from chunks of ``chunk`` characters with ``overlap`` in common.

    ``encode`` gives (ids, offsets). From the second chunk on, the text before the splice
    comes from the left encoding and the rest from the right one. A splice is a position in
    the overlap that is stable in the text and a token boundary in both encodings; if there
    is none, the overlap doubles, up to the whole rest of the text.
    """
    out: list[int] = []
    begin, wide = 0, overlap
    ids, offsets = encode(text[:chunk])
    end = min(chunk, len(text))
    while end < len(text):
        right = max(begin, end - wide)
        ahead = min(len(text), right + wide + chunk)
        right_ids, right_offsets = encode(text[right:ahead])
        left_starts = {begin + a: k for k, (a, _) in enumerate(offsets)}
        right_starts = {right + a: k for k, (a, _) in enumerate(right_offsets)}
        both = [p for p in left_starts if right < p < end and p in right_starts and stable(text, p)]
        if both:
            splice = both[len(both) // 2]
            out += ids[: left_starts[splice]]
            keep = right_starts[splice]
            ids, offsets, begin, end, wide = right_ids[keep:], [(right + a - splice, right + b - splice) for a, b in right_offsets[keep:]], splice, ahead, overlap
        elif right > begin:
            wide *= 2
        else:  # the whole of what is open has no common boundary: read on instead
            end = min(len(text), end + chunk + wide)
            ids, offsets = encode(text[begin:end])
    return out + ids


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, chunk: int = 32768, overlap: int = 256) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text; a null text counts as empty.

    Texts of up to ``chunk`` characters are encoded at once, longer ones in chunks, so that
    no call holds the encoding of a huge text. Repeated rows are counted each. Only doc_id
    and text are read.
    """

    def count(batches):
        tokenizer = load_tokenizer(tokenizer_path)

        def with_offsets(part: str):
            e = tokenizer.encode(part, add_special_tokens=False)
            return e.ids, e.offsets

        for batch in batches:
            texts, n = batch.column("text").to_pylist(), []
            for at in range(0, len(texts), 256):
                some = [t or "" for t in texts[at : at + 256]]
                short = iter(tokenizer.encode_batch_fast([t for t in some if len(t) <= chunk], add_special_tokens=False))
                n += [len(next(short)) if len(t) <= chunk else len(chunked_ids(with_offsets, t, chunk, overlap)) for t in some]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    sized = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = sized.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
