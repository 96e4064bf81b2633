"""Whole texts to ids of a word BPE vocabulary, by the tokenizers library.

White space never survives this vocabulary's normaliser and pre-tokeniser, so a text's ids are those of its
white-space-separated pieces in order. A batch of texts is split and its distinct pieces are found by Arrow. A plain piece
is cut into words, digits and signs as the pre-tokeniser would cut it; each worker has the library encode a word it
doesn't know once, many in one call, and the texts' ids are gathered from those of the words. Other pieces are encoded
whole. The memory of words is bounded: when it is full, it starts anew with those of the batch at hand. ASCII capitals,
which the normaliser lowers anyway, are lowered first, so that fewer pieces differ.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, normalizers, pre_tokenizers

#: Visible ASCII without capitals, and lower-case letters of Latin-1: composed already and in lower case.
PLAIN = "^[!-@\\[-~ß-öø-ÿ]+$"
#: The pre-tokeniser's cuts within such pieces, and the space that is set between them.
CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]| |[^a-zß-öø-ÿ0-9 ]+")
VOCABULARY = "word_bpe_49k.json"
END = 1
#: What ends a word's last token in this vocabulary.
WORD_END = "</w>"


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start .. start + size - 1 of each span, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class WordBpe:
    def __init__(self, path: str, most_words: int = 500_000) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.normal, self.cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.words = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.most = most_words
        self.empty()

    def empty(self) -> None:
        """Known words by number; their ids stand in flat, one word after the other. Number 0 is the space."""
        self.known, self.flat, self.sizes = {" ": 0}, np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def learn(self, words: list[str]) -> None:
        """New words, digits or signs, each of which the pre-tokeniser would leave whole."""
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = normalizers.Sequence([]), self.words
        flat, sizes = [self.flat], [self.sizes]
        for at in range(0, len(words), 25_000):
            lines = [" ".join(words[a : min(a + 500, at + 25_000)]) for a in range(at, min(at + 25_000, len(words)), 500)]
            for e in self.tokenizer.encode_batch(lines, add_special_tokens=False):
                ids = np.array(e.ids, np.uint32)
                sizes.append(np.diff(np.flatnonzero(self.ends[ids]) + 1, prepend=0))  # each word ends with one such token
                flat.append(ids)
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.normal, self.cut
        self.flat, self.sizes = np.concatenate(flat), np.concatenate(sizes)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))

    def plain(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain pieces, one after the other, and how many each has."""
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), " ")[0].as_py()
        words = CUT.findall(joined)
        fresh = [w for w in dict.fromkeys(words) if w not in self.known]
        if len(self.known) + len(fresh) > self.most:
            self.empty()
            fresh = [w for w in dict.fromkeys(words) if w != " "]
        if fresh:
            self.learn(fresh)
        number = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        each = self.sizes[number]
        ids = self.flat[spans((np.cumsum(self.sizes) - self.sizes)[number], each)]
        upto = np.concatenate([[0], np.cumsum(each)])
        bounds = upto[np.r_[0, np.flatnonzero(number == 0), len(number)]]
        return ids, np.diff(bounds)

    def whole(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of any pieces, with normaliser and pre-tokeniser: in lines, an id belongs to the piece that its
        place in the line is in; pieces with a mark's beginning each by itself."""
        ids: list = [None] * len(pieces)
        marked = ["<|" in p for p in pieces]
        for i in np.flatnonzero(marked).tolist():
            ids[i] = np.array(self.tokenizer.encode(pieces[i], add_special_tokens=False).ids, np.uint32)
        rest = np.flatnonzero(~np.array(marked, bool)).tolist()
        for at in range(0, len(rest), 500):
            some = rest[at : at + 500]
            e = self.tokenizer.encode(" ".join(pieces[i] for i in some), add_special_tokens=False)
            places = np.array(e.offsets, np.int64).reshape(-1, 2)[:, 0]
            cuts = np.searchsorted(places, np.cumsum([len(pieces[i]) + 1 for i in some]))
            for i, part in zip(some, np.split(np.array(e.ids, np.uint32), cuts[:-1]), strict=True):
                ids[i] = part
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.fromiter(map(len, ids), np.int64, len(ids))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has; a null text counts as empty."""
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        # lower case but where a mark's spelling might arise from it
        lower = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(lower)
        coded = split.flatten().dictionary_encode()
        pieces = coded.dictionary
        is_plain = pc.and_(pc.match_substring_regex(pieces, PLAIN), pc.invert(pc.match_substring(pieces, "<|")))
        plain = is_plain.to_numpy(zero_copy_only=False)
        parts = (self.plain(pieces.filter(is_plain)), self.whole(pieces.filter(pc.invert(is_plain)).to_pylist()))
        flat = np.concatenate([parts[0][0], parts[1][0]])
        sizes, starts = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        for rows, (_, n), before in ((plain, parts[0], 0), (~plain, parts[1], len(parts[0][0]))):
            sizes[rows], starts[rows] = n, np.cumsum(n) - n + before
        place = coded.indices.to_numpy()
        each = sizes[place]
        ids = flat[spans(starts[place], each)]
        upto = np.concatenate([[0], np.cumsum(each)])
        bounds = upto[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return ids, np.diff(bounds)

    def encode_ended(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As encode(), with the end id after each text."""
        ids, sizes = self.encode(texts)
        out = np.full(len(ids) + len(sizes), END, np.uint32)
        sizes = sizes + 1
        own = np.ones(len(out), bool)
        own[np.cumsum(sizes) - 1] = False
        out[own] = ids
        return out, sizes


@lru_cache(maxsize=1)
def word_bpe(path: str | None = None) -> WordBpe:
    return WordBpe(path or public_tokenizers.path(VOCABULARY))


def runs(texts: pa.Array, most_bytes: int = 6_000_000) -> list[tuple[int, int]]:
    """Runs of texts of about most_bytes bytes, so that a batch of long texts is encoded in parts."""
    out, a, n = [], 0, 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        n += size
        if n >= most_bytes:
            out.append((a, i + 1))
            a, n = i + 1, 0
    return [*out, (a, len(texts))] if a < len(texts) else out
