"""Token ids of whole Arrow batches of texts, exactly as the tokenizers library gives them."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The pre-tokenizer pattern, normalizers and end mark for which the word memo below knows the pieces of a word.
WORD_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_BPE_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
WORD_END = "</w>"
#: The same pieces, for words of printable ASCII and the Latin-1 letters only; and the line end that parts such words.
LATIN_PIECES = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
NOT_LATIN = re.compile(r"[^!-~À-ÖØ-öø-ÿ]")
#: Words and pieces a memo holds before it starts anew; some 200 bytes each.
MEMO_WORDS, MEMO_PIECES = 700_000, 300_000
#: Bytes of text that are encoded at a time; what this takes meanwhile is many times as much.
SLICE_BYTES = 6_000_000


def load_tokenizer(path: str):
    """The tokenizer of a file, on one thread, as Spark already runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def splits_at_spaces(path: str) -> bool:
    """Whether the tokenizer drops white space, never joins what stands on both sides of it, and marks ends of pieces."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    normal = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    marked = spec["model"].get("end_of_word_suffix") == WORD_END
    return marked and parts[0].get("pattern") == {"Regex": WORD_BPE_PATTERN} and parts[0].get("behavior") == "Removed" and normal == WORD_BPE_NORMALIZERS


class Pool:
    """Id lists by slot, in one flat array. Slots follow the order of the keys."""

    def __init__(self):
        self.slot: dict[str, int] = {}
        self.ids, self.sizes, self.begins = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.used = np.zeros(0, bool)

    def add(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.slot.update(zip(keys, range(len(self.sizes), len(self.sizes) + len(keys)), strict=True))
        if not keys:
            return
        begins = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids, self.sizes, self.begins = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes]), np.concatenate([self.begins, begins])
        self.used = np.concatenate([self.used, np.zeros(len(keys), bool)])

    def slots(self, keys: list[str]) -> np.ndarray:
        """The slot of each key, -1 for one that is not known."""
        return np.fromiter(map(self.slot.get, keys, repeat(-1)), np.int64, len(keys))

    def met(self, keys: list[str]) -> np.ndarray:
        """Like ``slots``, of keys that occur in a text."""
        found = self.slots(keys)
        self.used[found[found >= 0]] = True
        return found

    def renewed(self, most: int) -> Pool:
        """A pool of the keys that were met after they were added, if those are at most so many; else an empty one."""
        pool, at = Pool(), np.flatnonzero(self.used)
        if 0 < len(at) <= most:
            keys = list(self.slot)
            ids, ends = self.gather(at)
            pool.add([keys[i] for i in at], ids, np.diff(ends))
        return pool

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets) of the lists at the slots."""
        sizes = self.sizes[slots]
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return self.ids[np.repeat(self.begins[slots] - ends[:-1], sizes) + np.arange(ends[-1])], ends


class BatchEncoder:
    """Encodes batches of texts to flat id arrays with offsets.

    For tokenizers that split at white space, a text's ids are those of its words in turn,
    so each batch's distinct words are found by Arrow and only words not met before are
    looked at. Such words are cut into the pieces the pre-tokenizer would cut, if they hold
    plain Latin letters only; new pieces go to the library many at a time, parted by
    spaces, and its end marks part their ids again. Any other word is encoded as it
    stands. Other tokenizers encode each text directly. The memo is bounded: when it is full,
    words that were met in one slice only are forgotten.
    """

    def __init__(self, path: str, memo_words: int | None = None):
        self.tokenizer, self.memo_words = load_tokenizer(path), memo_words or MEMO_WORDS
        self.by_word = splits_at_spaces(path)
        specials = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.not_plain = "|".join([NOT_LATIN.pattern, *specials])
        self.is_end = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.is_end[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(WORD_END)]] = True
        self.words, self.pieces = Pool(), Pool()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_pieces(self, new: list[str]) -> None:
        lists = self._encode([" ".join(new[at : at + 256]) for at in range(0, len(new), 256)])
        ids = np.fromiter((i for x in lists for i in x), np.uint32)
        ends = np.flatnonzero(self.is_end[ids]) + 1
        self.pieces.add(new, ids, np.diff(ends, prepend=0))

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Add new words, and return their slots."""
        slots, words = np.zeros(len(new), np.int64), new.to_pylist()
        strange = np.asarray(pc.match_substring_regex(new, self.not_plain))
        for at, add in ((np.flatnonzero(strange), self._add_whole), (np.flatnonzero(~strange), self._add_plain)):
            if len(at):
                slots[at] = len(self.words.sizes) + np.arange(len(at))
                add([words[i] for i in at])
        return slots

    def _add_whole(self, words: list[str]) -> None:
        lists = self._encode(words)
        self.words.add(words, np.fromiter((i for x in lists for i in x), np.uint32), np.fromiter(map(len, lists), np.int64))

    def _add_plain(self, words: list[str]) -> None:
        found = LATIN_PIECES.findall("\n".join(words).lower() + "\n")
        if len(self.pieces.slot) > MEMO_PIECES:
            self.pieces = self.pieces.renewed(MEMO_PIECES // 2)
        if "\n" not in self.pieces.slot:
            self.pieces = Pool()
            self.pieces.add(["\n"], np.zeros(0, np.uint32), np.zeros(1, np.int64))
        slots = self.pieces.met(found)
        new = np.flatnonzero(slots < 0)
        if len(new):
            missing = [found[i] for i in new]
            self._learn_pieces(list(dict.fromkeys(missing)))
            slots[new] = self.pieces.slots(missing)
        ids, ends = self.pieces.gather(slots)
        self.words.add(words, ids, np.diff(ends[1:][slots == 0], prepend=0))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts: the ids of text i are ids[offsets[i]:offsets[i + 1]]; null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_word:
            lists = self._encode(texts.to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]).astype(np.int64)
            return np.fromiter((i for x in lists for i in x), dtype=np.uint32, count=int(offsets[-1])), offsets
        words = pc.ascii_split_whitespace(texts)
        starts = np.asarray(words.offsets, dtype=np.int64)
        coded = words.flatten().dictionary_encode()
        known = coded.dictionary.to_pylist()
        if len(self.words.slot) + len(known) > self.memo_words:
            self.words = self.words.renewed(self.memo_words // 2)
        slots = self.words.met(known)
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = self._learn(coded.dictionary.take(pa.array(new)))
        ids, ends = self.words.gather(slots[np.asarray(coded.indices, dtype=np.int64)])
        return ids, ends[starts - starts[0]]


@lru_cache(maxsize=2)
def encoder(path: str, memo_words: int | None = None) -> BatchEncoder:
    """One encoder per Python worker, kept between tasks."""
    return BatchEncoder(path, memo_words)


def release() -> None:
    """Give back what Arrow keeps for later in this worker; a worker outlives its tasks."""
    pa.default_memory_pool().release_unused()


def slices(texts: pa.Array, most_bytes: int = SLICE_BYTES):
    """Ranges of rows of a batch of about so many bytes of text, one row at least, to bound what numpy holds."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most_bytes:
            yield begin, i
            begin, held = i, 0
        held += int(size)
    if begin < len(sizes):
        yield begin, len(sizes)
