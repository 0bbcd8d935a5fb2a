"""The last token of every prefix, for many pieces at once.

For every prefix of a piece exactly one token can end its encoding. An automaton over the vocabulary, whose suffix
links list all tokens that end at a position, gives the candidates; the right one is the one that may stand beside
the last token of the prefix before it. All pieces are worked on together, position by position.
"""

import numpy as np

from kerbside.llm.wordcache import mix

#: Longer pieces are worked on one by one.
TOGETHER = 96

_SEPARATOR = "\U0010FFFF"


class PairTable:
    """Remembers the answer of ``test(a, b)`` for token pairs in an open hash table of bounded size."""

    def __init__(self, test, bits=21):
        self.test, self.bits = test, bits
        self._clear()

    def _clear(self):
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.answers = np.zeros(1 << self.bits, bool)
        self.count = 0

    def _slot(self, keys):
        return (mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, keys):
        """The slot of each key, or the free slot where it belongs."""
        slots, wrap = self._slot(keys), (1 << self.bits) - 1
        held = self.keys[slots]
        todo = np.flatnonzero((held != keys) & (held >= 0))
        while len(todo):
            slots[todo] = (slots[todo] + 1) & wrap
            held = self.keys[slots[todo]]
            todo = todo[(held != keys[todo]) & (held >= 0)]
        return slots

    def __call__(self, before, after):
        keys = before.astype(np.int64) << 20 | after
        slots = self._find(keys)
        missing = np.unique(keys[self.keys[slots] < 0])
        if len(missing):
            if self.count + len(missing) > 1 << (self.bits - 1):
                self._clear()
                missing = np.unique(keys)
            answers = np.array([self.test(key >> 20, key & 0xFFFFF) for key in missing.tolist()])
            left = np.arange(len(missing))
            while len(left):  # of keys that fall to one free slot, one goes in at a time
                at = self._find(missing[left])
                _, first = np.unique(at, return_index=True)
                self.keys[at[first]], self.answers[at[first]] = missing[left[first]], answers[left[first]]
                left = np.delete(left, first)
            self.count += len(missing)
            slots = self._find(keys)
        return self.answers[slots]

    def one(self, before, after):
        return bool(self(np.array([before]), np.array([after]))[0])


class PrefixDP:
    """``tokens``: text of each usable token by id; ``test(a, b)``: whether two tokens may stand side by side.

    Every single character of a piece must be a token.
    """

    def __init__(self, tokens, test):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        self.width = np.zeros(max(tokens) + 1, np.int64)
        for i, text in tokens.items():
            self.automaton.add_word(text, i)
            self.width[i] = len(text)
        self.automaton.make_automaton()
        self.pairs = PairTable(test)

    def last_tokens(self, pieces):
        """``(last, starts)``: ``last[starts[k] + p]`` is the last token of the prefix of length ``p`` of piece ``k``.

        Where ``p`` is 0 it is -1.
        """
        lengths = np.array([len(p) for p in pieces], np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1
        last = np.full(int(lengths.sum()) + len(pieces), -1, np.int64)
        found = np.fromiter(self.automaton.iter(_SEPARATOR.join(pieces)), [("end", np.int64), ("token", np.int64)])
        end, token = found["end"] + 1, found["token"]
        begin = np.repeat(starts, lengths + 1)
        where = end - begin[end]
        order = np.argsort(where, kind="stable")
        end, token, where = end[order], token[order], where[order]
        source = end - self.width[token]
        steps = np.flatnonzero(np.diff(where, prepend=0, append=0))
        for a, b in zip(steps[:-1], steps[1:]):
            before, here = last[source[a:b]], token[a:b]
            fits = before < 0
            inner = np.flatnonzero(~fits)
            fits[inner] = self.pairs(before[inner], here[inner])
            last[end[a:b][fits]] = here[fits]
        return last, starts

    def last_tokens_of_one(self, piece):
        """The same for one piece, in time linear in its length."""
        last, done, width, pairs = [-1] * (len(piece) + 1), -1, self.width.tolist(), {}
        for end, token in self.automaton.iter(piece):
            if end == done:
                continue
            before = last[end + 1 - width[token]]
            if before >= 0:
                fits = pairs.get((before, token))
                if fits is None:
                    fits = pairs[before, token] = self.pairs.one(before, token)
                if not fits:
                    continue
            last[end + 1], done = token, end
        return last

    def prefix_counts(self, pieces):
        """The token counts of all prefixes of all pieces, from length 1 on, in one array."""
        short = [k for k, p in enumerate(pieces) if len(p) <= TOGETHER]
        if short:
            last, starts = self.last_tokens([pieces[k] for k in short])
            where = np.arange(len(last)) - np.repeat(starts, np.diff(np.r_[starts, len(last)]))
            counts, order = np.zeros(len(last), np.int64), np.argsort(where, kind="stable")
            steps = np.r_[np.flatnonzero(np.diff(where[order], prepend=-1)), len(order)]
            for a, b in zip(steps[1:-1], steps[2:]):
                at = order[a:b]
                counts[at] = counts[at - self.width[last[at]]] + 1
            if len(short) == len(pieces):
                return counts[where > 0]
            ends = np.r_[starts[1:], len(last)]
            out = {k: counts[a + 1:b] for k, a, b in zip(short, starts, ends)}
        else:
            out = {}
        for k, piece in enumerate(pieces):
            if len(piece) > TOGETHER:
                counts = [0] * (len(piece) + 1)
                for at, token in enumerate(self.last_tokens_of_one(piece)[1:], 1):
                    counts[at] = counts[at - int(self.width[token])] + 1
                out[k] = np.array(counts[1:])
        return np.concatenate([out[k] for k in range(len(pieces))])

    def encode(self, pieces):
        """``(ids, counts)``: the ids of all pieces in one array, and how many each piece has."""
        short = [k for k, p in enumerate(pieces) if len(p) <= TOGETHER]
        ids, counts = [np.zeros(0, np.int64)] * len(pieces), np.zeros(len(pieces), np.int64)
        if short:
            last, starts = self.last_tokens([pieces[k] for k in short])
            at = starts + np.array([len(pieces[k]) for k in short])
            owner, trail, which = np.arange(len(short)), [], []
            while len(owner):
                tokens = last[at]
                inside = tokens >= 0
                owner, at, tokens = owner[inside], at[inside], tokens[inside]
                trail.append(tokens)
                which.append(owner)
                at = at - self.width[tokens]
            tokens, owner = np.concatenate(trail)[::-1], np.concatenate(which)[::-1]
            tokens = tokens[np.argsort(owner, kind="stable")]
            counts[short] = np.bincount(owner, minlength=len(short))
            if len(short) == len(pieces):
                return tokens, counts
            for k, part in zip(short, np.split(tokens, np.cumsum(counts[short])[:-1])):
                ids[k] = part
        for k, piece in enumerate(pieces):
            if len(piece) > TOGETHER:
                last, at, back = self.last_tokens_of_one(piece), len(piece), []
                while at:
                    back.append(last[at])
                    at -= int(self.width[last[at]])
                ids[k], counts[k] = np.array(back[::-1]), len(back)
        return np.concatenate(ids), counts
