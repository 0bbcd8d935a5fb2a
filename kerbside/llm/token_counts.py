"""Token counts at every prefix of a text, without encoding anything twice.

A piece-vocabulary BPE model merges the best-scored pair of neighbours, whatever they were made from. For every prefix
exactly one token can come last, so ``count[p] = count[p - width of the last token] + 1``. The counts of all
prefixes answer how long a text is in tokens, where it must be cut to fit a budget, and what any part of it from the
beginning costs. Texts fall into pieces that no merge crosses; the prefix counts of each distinct piece are worked out
once and kept in a cache of bounded size.
"""

import re

import numpy as np
import pyarrow as pa

from kerbside.llm.batches import held, map_texts, pick, texts_of
from kerbside.llm.prefixdp import PrefixDP
from kerbside.llm.wordcache import Flat, WordCache, code_points

BLANK = "▁"
SENTINEL = 0x10FFFF + 1


class Vocabulary:
    """Pieces and scores of a model file, and which pieces may stand side by side."""

    def __init__(self, path):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        if not any(model.is_byte(i) for i in range(n)):
            raise ValueError("a model with byte fallback is needed")
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
        texts = {i: model.id_to_piece(i) for i in plain}
        self.texts = texts
        usable = {i: t for i, t in texts.items() if self.merge(t) == [t]}
        self.prefixes = PrefixDP(usable, self._apart)
        self.known = np.zeros(SENTINEL + 1, bool)
        self.known[[ord(t) for t in texts.values() if len(t) == 1]] = True
        #: No piece goes on with a blank after something else, so no merge crosses there.
        self.blank_splits = not any(re.search(f"[^{BLANK}]{BLANK}", t) for t in texts.values())

    def merge(self, text):
        """The pieces of a short text, by the rule itself: the best score first, from the left among equals."""
        parts, scores = list(text), self.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _apart(self, a, b):
        a, b = self.texts[a], self.texts[b]
        return self.merge(a + b) == [a, b]

    def starts(self, codes):
        known = self.known[codes]
        start = ~known
        start[1:] |= ~known[:-1]
        start[0] = True
        if self.blank_splits:
            blank = codes == ord(BLANK)
            start[1:] |= blank[1:] & ~blank[:-1]
        return np.flatnonzero(start)

    def prefix_counts(self, pieces):
        """The counts of all prefixes of all pieces, from length 1 on, in one array."""
        if not pieces:
            return np.zeros(0, np.int64)
        widths = np.array([len(p) for p in pieces])
        foreign = np.array([len(p) == 1 and not self.known[ord(p)] for p in pieces])
        counts = np.zeros(int(widths.sum()), np.int64)
        begins = np.cumsum(widths) - widths
        counts[begins[foreign]] = [len(pieces[k].encode()) for k in np.flatnonzero(foreign)]
        own = np.flatnonzero(~foreign)
        if len(own):
            part = self.prefixes.prefix_counts([pieces[k] for k in own])
            counts[np.repeat(~foreign, widths)] = part
        return counts


class Counter:
    """Prefix counts of texts; ``texts`` may be of any length."""

    def __init__(self, path):
        self.vocabulary = Vocabulary(path)
        self.cache = WordCache(self._add, self._clear, lambda: self.counts.nbytes)
        self._clear()

    def _clear(self):
        self.counts = Flat()

    def _add(self, codes, starts, ends):
        pieces = [codes[a:b].astype("<u4").tobytes().decode("utf-32-le") for a, b in zip(starts.tolist(), ends.tolist())]
        self.counts.extend(self.vocabulary.prefix_counts(pieces), ends - starts)

    def pieces(self, texts):
        """For each text ``(numbers, widths)`` of its pieces; the first has a blank more than the text."""
        blank, mark = np.array([ord(BLANK)], np.uint32), np.array([SENTINEL], np.uint32)
        if not texts:
            return []
        codes = np.concatenate([x for t in texts for x in ((blank, code_points(t), mark) if t else (mark,))])
        codes[codes == 32] = ord(BLANK)
        starts = self.vocabulary.starts(codes)
        ends = np.r_[starts[1:], len(codes)]
        word = codes[starts] != SENTINEL
        borders = np.cumsum(word)[~word]
        starts, ends = starts[word], ends[word]
        numbers = self.cache.numbers(codes, starts, ends) if len(starts) else np.zeros(0, np.int64)
        widths = ends - starts
        return [(numbers[a:b], widths[a:b]) for a, b in zip(np.r_[0, borders[:-1]], borders)]

    def totals_and_cuts(self, texts, limits):
        """For each text its count, and for each limit the length of the longest prefix that keeps to it."""
        found = self.pieces(texts)
        flat, offsets, widths = self.counts.arrays()
        totals = flat[offsets + widths - 1] if len(offsets) else np.zeros(0, np.int64)
        for numbers, _ in found:
            ends = np.cumsum(totals[numbers])
            n = int(ends[-1]) if len(ends) else 0
            yield n, [self._cut(numbers, ends, n, flat, offsets, widths, limit) for limit in limits]

    @staticmethod
    def _cut(numbers, ends, n, flat, offsets, widths, limit):
        if n <= limit:
            return max(0, int(widths[numbers].sum()) - 1)
        # The last piece that begins below the limit; a prefix that ends in it costs at least one token of it.
        k = int(np.searchsorted(ends, limit, "left"))
        while k >= 0:
            before = int(ends[k - 1]) if k else 0
            own = flat[offsets[numbers[k]]:offsets[numbers[k]] + widths[numbers[k]]]
            fits = np.flatnonzero(own + before <= limit)
            if len(fits):
                return max(0, int(widths[numbers[:k]].sum()) + int(fits[-1]))
            k -= 1
        return 0

    def every(self, texts):
        """For each text the counts of its prefixes of length 0, 1, 2 and so on."""
        found = self.pieces(texts)
        flat, offsets, widths = self.counts.arrays()
        for numbers, _ in found:
            own = [flat[offsets[k]:offsets[k] + widths[k]] for k in numbers.tolist()]
            before = np.cumsum([0, *(int(c[-1]) for c in own)])
            counts = np.concatenate([np.zeros(1, np.int64), *(c + b for c, b in zip(own, before))])
            counts = np.r_[0, counts[2:]] if len(counts) > 1 else counts  # the added blank alone is no prefix
            yield counts.astype(np.int32)


def counter(path):
    """The counter of the running task."""
    return held(("counter", path), lambda: Counter(path))


def default_path():
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def count(df, limits=(4096,), path=None, id_col="doc_id", text_col="text"):
    """Count the tokens of whole texts: ``doc_id``, ``n_bytes``, ``n_tokens``, ``cuts``.

    ``cuts`` has for each of ``limits`` the number of characters of the longest prefix with at most so many tokens.
    Null and empty texts have no bytes and no tokens; repeated rows are counted each; other columns are not read.
    No shuffle, memory bounded by a chunk of texts.
    """
    path, limits = path or default_path(), tuple(limits)

    def work(batch):
        texts = texts_of(batch)
        found = list(counter(path).totals_and_cuts(texts, limits))
        return {"n_bytes": [len(t.encode()) for t in texts], "n_tokens": [n for n, _ in found], "cuts": [c for _, c in found]}

    return map_texts(pick(df, id_col, text_col), work, [
        pa.field("n_bytes", pa.int64()), pa.field("n_tokens", pa.int64()), pa.field("cuts", pa.list_(pa.int64()))])


def prefix_counts(df, path=None, id_col="doc_id", text_col="text"):
    """``doc_id``, ``counts``: the exact token count of every prefix of each whole text, from the empty one on."""
    path = path or default_path()
    return map_texts(pick(df, id_col, text_col), lambda batch: {"counts": list(counter(path).every(texts_of(batch)))},
                     [pa.field("counts", pa.list_(pa.int32()))])


def truncate(df, limit, path=None, id_col="doc_id", text_col="text"):
    """``doc_id``, ``text``: each text cut to its longest prefix of at most ``limit`` tokens; null stays empty."""
    path = path or default_path()

    def work(batch):
        texts = texts_of(batch)
        return {"kept": [t[:cuts[0]] for t, (_, cuts) in zip(texts, counter(path).totals_and_cuts(texts, (limit,)))]}

    return map_texts(pick(df, id_col, text_col), work, [pa.field("kept", pa.string())]).withColumnRenamed("kept", "text")
