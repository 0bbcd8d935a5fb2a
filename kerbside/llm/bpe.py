"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a piece exactly one token can end its encoding. An automaton over the vocabulary, whose
suffix links list all tokens that end at a position, gives the candidates; the right one is that whose
neighbour, the last token of the prefix before it, can stand beside it. Two tokens can stand side by side when
no merge across their border is ever due. Back-pointers from the end then give the exact ids. The work is
linear in the length of a piece, however long it is.
"""

import functools
import hashlib
import json
import re

import numpy as np
import pyarrow as pa

from kerbside.llm.batches import held, map_texts, per_task, pick, texts_of
from kerbside.llm.prefixdp import PrefixDP
from kerbside.llm.wordcache import Flat, WordCache, code_points, gather

# Classes of code points for splitting.
LETTER, NUMBER, SPACE, OTHER, END = 0, 1, 2, 3, 4
SENTINEL = 0x10FFFF + 1


@functools.lru_cache(1)
def classes():
    """The class of each code point, as the splitting pattern sees it; one more entry for the end of a text."""
    import regex
    out = np.full(SENTINEL + 1, OTHER, np.uint8)
    kinds = [(kind, regex.compile(p)) for kind, p in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+"))]
    # Piece by piece: a string of all characters costs a worker 120 MB.
    for low in range(0, SENTINEL, 1 << 12):
        some = "" if 0xD800 <= low < 0xE000 else "".join(map(chr, range(low, low + (1 << 12))))  # surrogates are none
        for kind, pattern in kinds:
            for m in pattern.finditer(some):
                out[low + m.start():low + m.end()] = kind
    out[SENTINEL] = END
    return out


def piece_starts(codes):
    """Where the pieces begin in code points; each text ends with SENTINEL, which is a piece of its own.

    A piece is a run of letters, of numbers or of other characters with one space before it if there is one, an
    English clitic after an apostrophe, or white space; of a white-space run before a word the last space goes
    with the word.
    """
    kind = classes()[codes]
    n = len(codes)
    start = np.ones(n, bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == END)
    # The last white space before a word stands alone; a plain space joins the word.
    before_word = np.zeros(n, bool)
    before_word[:-1] = (kind[:-1] == SPACE) & (kind[1:] < END) & (kind[1:] != SPACE)
    start |= before_word
    joins = before_word & (codes == 32)
    start[1:] &= ~joins[:-1]
    # Clitics: the apostrophe must itself begin a piece.
    marks = np.flatnonzero((codes == 39) & start)
    if len(marks):
        following = codes[np.minimum(marks[:, None] + [1, 2], n - 1)]
        one = np.isin(following[:, 0], [ord(c) for c in "stmd"])
        two = np.zeros(len(marks), bool)
        for pair in ("re", "ve", "ll"):
            two |= (following[:, 0] == ord(pair[0])) & (following[:, 1] == ord(pair[1]))
        for where, width in ((marks[one], 2), (marks[two], 3)):
            start[where + 1] = False
            start[where + width] = True
    return np.flatnonzero(start)


@functools.lru_cache(2)
def byte_alphabet():
    """Printable stand-in of each byte in the vocabulary file: itself if printable, else from 256 on in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file, with the compatibility of token pairs."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        stand_in = byte_alphabet()
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for word, i in ids.items():
            self.bytes[i] = bytes(map(stand_in.__getitem__, word))
        self.merged, self.parts, self.rank = {}, {}, {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, c = ids[left], ids[right], ids[left + right]
            self.merged[a, b] = rank
            self.parts.setdefault(c, (a, b))
            self.rank.setdefault(c, rank)
        for content, i in self.special.items():
            self.bytes[i] = content.encode()
        self.spines = ({}, {})
        self.whole = {}
        for i in sorted(ids.values(), key=lambda i: self.rank.get(i, -1)):
            self.whole[i] = self._whole(i)
        self.prefixes = PrefixDP({i: self.bytes[i].decode("latin-1") for i, whole in self.whole.items() if whole},
                                 lambda a, b: not self._crossed(a, b))
        self.texts = Flat(np.uint8)
        self.texts.extend(np.frombuffer(b"".join(self.bytes), np.uint8), [len(b) for b in self.bytes])
        written = [b"%d," % i for i in range(size)]
        self.decimals = Flat(np.uint8)
        self.decimals.extend(np.frombuffer(b"".join(written), np.uint8), [len(b) for b in written])

    def _spine(self, token, side):
        """A token and its outermost parts on one side, each with the rank of the merge that takes it in."""
        known = self.spines[side].get(token)
        if known is not None:
            return known
        out, top = [(token, float("inf"))], token
        while token in self.parts:
            rank, token = self.rank[token], self.parts[token][side]
            out.append((token, rank))
        self.spines[side][top] = out
        return out

    def _crossed(self, a, b, until=float("inf")):
        """Whether a merge across the border of ``a`` and ``b`` is due before rank ``until``.

        Equal ranks merge from left to right: the part in ``a`` is then taken in first, the part in ``b`` last.
        """
        for x, x_taken in self._spine(a, 1):
            for y, y_taken in self._spine(b, 0):
                rank = self.merged.get((x, y))
                if rank is not None and rank < x_taken and rank <= y_taken and rank < until:
                    return True
        return False

    def _whole(self, token):
        """Whether the text of a token is encoded as that token alone."""
        if token not in self.parts:
            return len(self.bytes[token]) == 1
        a, b = self.parts[token]
        return self.whole[a] and self.whole[b] and not self._crossed(a, b, self.rank[token])

    def encode(self, pieces):
        """Ids of pieces in one array, and how many each has."""
        return self.prefixes.encode([p.encode().decode("latin-1") for p in pieces])

    def decode(self, ids):
        """The bytes of ids, special tokens included."""
        return gather(*self.texts.arrays(), ids).tobytes()

    def write(self, ids):
        """The ids in decimal, joined by commas, as bytes."""
        return gather(*self.decimals.arrays(), ids).tobytes()[:-1]


class Encoder:
    """Encodes lists of texts; the distinct pieces seen lately are kept with their ids."""

    def __init__(self, path):
        self.vocabulary = Vocabulary(path)
        self.specials = sorted(self.vocabulary.special, key=len, reverse=True)
        self.cache = WordCache(self._add, self._clear, lambda: self.ids.nbytes)
        self._clear()

    def _clear(self):
        self.ids = Flat()

    def _add(self, codes, starts, ends):
        pieces = [codes[a:b].astype("<u4").tobytes().decode("utf-32-le") for a, b in zip(starts.tolist(), ends.tolist())]
        self.ids.extend(*self.vocabulary.encode(pieces))

    def _parts(self, text):
        """A text cut at special tokens: ``[(part, id of the special token after it or None)]``."""
        if not any(s in text for s in self.specials):
            return [(text, None)]
        found = re.split("(" + "|".join(map(re.escape, self.specials)) + ")", text)
        return [(part, self.vocabulary.special.get(after))
                for part, after in zip(found[::2], [*found[1::2], None])]

    def pieces(self, texts):
        """For each text, its runs ``[(numbers of the pieces, special id or None)]``."""
        runs = [(i, part, special) for i, t in enumerate(texts) for part, special in self._parts(t)]
        out = [[] for _ in texts]
        if not runs:
            return out
        mark = np.array([SENTINEL], np.uint32)
        codes = np.concatenate([x for _, part, _ in runs for x in (code_points(part), mark)])
        starts = piece_starts(codes)
        ends = np.r_[starts[1:], len(codes)]
        word = codes[starts] != SENTINEL
        borders = np.cumsum(word)[~word]
        numbers = self.cache.numbers(codes, starts[word], ends[word])
        for (i, _, special), a, b in zip(runs, np.r_[0, borders[:-1]], borders):
            out[i].append((numbers[a:b], special))
        return out

    def encode(self, texts):
        """For each text, an int32 array of ids."""
        found = self.pieces(texts)
        held = self.ids.arrays()
        out = []
        for runs in found:
            parts = [np.zeros(0, np.int32)]
            for numbers, special in runs:
                parts.append(gather(*held, numbers))
                if special is not None:
                    parts.append(np.array([special], np.int32))
            out.append(np.concatenate(parts))
        return out

    def decode(self, ids):
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return self.vocabulary.decode(ids).decode("utf-8", "replace")


def encoder(path):
    """The encoder of the running task."""
    return held(("encoder", path), lambda: Encoder(path))


def default_path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encode(df, path=None, id_col="doc_id", text_col="text"):
    """Encode whole texts; one row per row: ``doc_id``, ``ids`` (list of int), ``n_tokens``.

    Null and empty texts have no ids; repeated rows are encoded each; other columns are not read. ``path`` is the
    tokenizer file, which every executor must have. A narrow step: no shuffle, memory bounded by a chunk of texts.
    """
    path = path or default_path()

    def work(batch):
        ids = encoder(path).encode(texts_of(batch))
        return {"ids": ids, "n_tokens": [len(x) for x in ids]}

    return map_texts(pick(df, id_col, text_col), work, [pa.field("ids", pa.list_(pa.int32())), pa.field("n_tokens", pa.int64())])


def decode(df, path=None, id_col="doc_id", ids_col="ids"):
    """Decode lists of ids to ``text``, special tokens included; null and empty lists give an empty text."""
    path = path or default_path()

    def work(batch):
        column = batch.column(batch.schema.get_field_index("text")).to_pylist()
        return {"decoded": [encoder(path).decode(np.array(ids or [], np.int64)) for ids in column]}

    from pyspark.sql import functions as F
    chosen = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{ids_col}`").alias("text"))
    schema_fields = [pa.field("decoded", pa.string())]
    return _map_lists(chosen, work, schema_fields).withColumnRenamed("decoded", "text")


def _map_lists(df, work, fields):
    from pyspark.sql.pandas.types import from_arrow_schema

    from kerbside.llm.batches import emit, id_field
    schema = pa.schema([id_field(df), *fields])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield emit(schema, doc_id=part.column(0), **work(part))

    return df.mapInArrow(per_task(run), from_arrow_schema(schema))


def round_trip(df, path=None, id_col="doc_id", text_col="text"):
    """Encode and decode whole texts in one step: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    The digests are those of the decimal ids joined by commas and of the decoded text in UTF-8; a null text
    counts as empty.
    """
    path = path or default_path()

    def work(batch):
        own, out = encoder(path), {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for ids in own.encode(texts_of(batch)):
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(own.vocabulary.write(ids)).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
        return out

    return map_texts(pick(df, id_col, text_col), work, [
        pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())])
