"""Benchmark decontamination by pigeonhole edit matching.

An item leaks into a document when some stretch of the document is within the item's error budget, in edit distance
over letters and digits in lower case. If an item is split into one piece more than its budget, any such stretch
holds one piece unchanged; an automaton finds all piece hits in one pass over a text, and Myers' bit-parallel
distance verifies the stretch around each hit.
"""

import functools
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kerbside.llm.batches import chunks, held, map_texts, per_task, pick, texts_of
from kerbside.llm.bpe import LETTER, NUMBER, classes
from kerbside.llm.wordcache import code_points
from kerbside.session import stage

#: Characters of benchmark items that are searched for at once; a larger benchmark is taken in blocks.
BLOCK_CHARS = 8_000_000


@functools.lru_cache(1)
def folding():
    """The lower-case letter or digit of each code point, 32 for all others."""
    out = np.full(0x110000, 32, np.uint32)
    plain = np.flatnonzero(np.isin(classes()[:0x110000], (LETTER, NUMBER)))
    out[plain] = [ord(low) if len(low := chr(c).lower()) == 1 else c for c in plain.tolist()]
    return out


def fold(texts):
    """``(codes, origin, begins)``: letters and digits of all texts in lower case with single blanks between.

    ``origin`` gives the position of each in its text, ``begins`` where each text begins; a line break ends each text.
    """
    raw = [code_points(t) for t in texts]
    sizes = np.array([len(r) for r in raw])
    codes = np.concatenate([x for r in raw for x in (folding()[r], np.array([10], np.uint32))])
    origin = np.concatenate([np.arange(n + 1) for n in sizes]) if len(sizes) else np.zeros(0, np.int64)
    keep = np.ones(len(codes), bool)
    blank = codes == 32
    keep[0] = not blank[0]
    keep[1:] &= ~(blank[1:] & (blank[:-1] | (codes[:-1] == 10)))
    keep[:-1] &= ~(blank[:-1] & (codes[1:] == 10))
    while True:  # a run of blanks at the end leaves its first
        codes, origin = codes[keep], origin[keep]
        keep = np.ones(len(codes), bool)
        keep[:-1] = ~((codes[:-1] == 32) & (codes[1:] == 10))
        if keep.all():
            break
    ends = np.flatnonzero(codes == 10)
    return codes, origin, np.r_[0, ends[:-1] + 1], ends


def fold_one(text):
    codes, _, _, ends = fold([text])
    return codes[:ends[0]].astype("<u4").tobytes().decode("utf-32-le")


def pieces(item, budget):
    """``budget + 1`` pieces of like size with their offsets."""
    n = len(item)
    cuts = [n * k // (budget + 1) for k in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def best_stretch(item, text, budget, masks=None):
    """``(distance, end)`` of the stretch of ``text`` nearest to ``item``, the first of equals; None beyond the budget."""
    masks = masks or character_masks(item)
    m = len(item)
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, min((budget + 1, -1), (m, 0))
    for j, c in enumerate(text):
        equal = masks.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (~(horizontal | plus) & full)
        down = plus & horizontal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | (~(vertical | up) & full), up & vertical
        if score < best[0]:
            best = (score, j + 1)
    return best if best[0] <= budget else None


def character_masks(item):
    masks = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


class Matcher:
    """Finds a bounded block of items in texts."""

    def __init__(self, items, share):
        import ahocorasick
        self.items = items  # [(id, folded text)]
        self.budgets = [int(len(t) * share) for _, t in items]
        self.masks = [character_masks(t) for _, t in items]
        self.automaton, found = ahocorasick.Automaton(), {}
        for k, ((_, text), budget) in enumerate(zip(items, self.budgets)):
            for offset, piece in pieces(text, budget):
                found.setdefault(piece, []).append((k, offset, len(piece)))
        for piece, where in found.items():
            self.automaton.add_word(piece, where)
        if found:
            self.automaton.make_automaton()
        self.any = bool(found)

    def search(self, texts):
        """For each text ``{item index: (distance, start, end)}`` with positions in the text itself."""
        out = [{} for _ in texts]
        if not self.any or not texts:
            return out
        codes, origin, begins, ends = fold(texts)
        flat = codes.astype("<u4").tobytes().decode("utf-32-le")
        starts, tried = begins.tolist(), set()
        for end, where in self.automaton.iter(flat):
            which = bisect_right(starts, end) - 1
            for k, offset, width in where:
                budget, n = self.budgets[k], len(self.items[k][1])
                at = end + 1 - width - offset
                known = out[which].get(k)
                if (known and known[0] == 0) or (which, k, at) in tried:
                    continue
                tried.add((which, k, at))
                low, high = max(starts[which], at - budget), min(int(ends[which]), at + n + budget)
                if high - low < n - budget:
                    continue
                found = best_stretch(self.items[k][1], flat[low:high], budget, self.masks[k])
                if found and (not known or found[0] < known[0]):
                    stop = low + found[1]
                    begin = max(low, stop - n)
                    out[which][k] = (found[0], int(origin[begin]), int(origin[stop - 1]) + 1)
        return out


def item_blocks(benchmark, share, id_col="item_id", text_col="text", block_chars=BLOCK_CHARS):
    """The items folded, in blocks of bounded size; null texts and texts without a letter or digit are left out."""
    items = benchmark.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("id IS NOT NULL AND text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(total // block_chars) + 1
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).orderBy("id", "text").collect()
        yield [(r.id, t) for r in rows if (t := fold_one(r.text))]


class _Shared:
    """A broadcast block of items; the automaton is built once in each task."""

    def __init__(self, spark, items, share):
        self.box, self.share = spark.sparkContext.broadcast(items), share

    def get(self):
        return held(("matcher", id(self.box.value)), lambda: Matcher(self.box.value, self.share))


def leaks(df, benchmark, share=0.05, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text", block_chars=BLOCK_CHARS):
    """Benchmark items in whole documents; one row per row.

    ``doc_id``, ``n_items``, ``items`` (sorted ids, each once), ``distances`` (least edit distance of each),
    ``starts`` and ``ends`` (where in the text). ``share`` of an item's length is its error budget. Null and empty texts
    hold no item; items without a letter or digit, or with a null id or text, are never found; repeated rows are
    searched each; with an empty benchmark nothing leaks. Items reach the executors in blocks of bounded size: one
    block is one pass without a shuffle, more blocks are united by a row key.
    """
    docs = pick(df, id_col, text_col)
    # One block at a time is on the driver; the second tells whether there is more than one.
    blocks = (b for b in item_blocks(benchmark, share, item_col, item_text_col, block_chars) if b)
    block, after = next(blocks, []), next(blocks, None)
    if after is None:
        return _one_block(docs, _Shared(docs.sparkSession, block, share))
    keyed = stage(docs.withColumn("row", F.monotonically_increasing_id()), "leaks")
    found = None
    while block is not None:
        shared = _Shared(docs.sparkSession, block, share)
        part = stage(_one_block(keyed.select(F.col("row").alias("doc_id"), "text"), shared).where("n_items > 0"), "leaks")
        shared.box.destroy()
        found = part if found is None else found.unionByName(part)
        block, after = after, next(blocks, None)
    each = found.withColumn("f", F.explode(F.arrays_zip("items", "distances", "starts", "ends")))
    some = each.groupBy(F.col("doc_id").alias("row")).agg(F.array_sort(F.collect_list("f")).alias("f"))
    joined = keyed.select("row", "doc_id").join(some, "row", "left")
    empty = F.array().cast("array<long>")
    return joined.select("doc_id", F.coalesce(F.size("f"), F.lit(0)).cast("long").alias("n_items"), *[
        F.coalesce(F.col(f"f.{n}"), empty.cast(found.schema[n].dataType)).alias(n) for n in ("items", "distances", "starts", "ends")])


def _item_type(items):
    return pa.string() if items and isinstance(items[0][0], str) else pa.int64()


def _one_block(docs, shared):
    def work(batch):
        out = {"n_items": [], "items": [], "distances": [], "starts": [], "ends": []}
        own = shared.get()
        for found in own.search(texts_of(batch)):
            best = {}
            for k, hit in found.items():
                item = own.items[k][0]
                best[item] = min(best.get(item, hit), hit)
            order = sorted(best)
            out["n_items"].append(len(order))
            out["items"].append(order)
            for i, name in enumerate(("distances", "starts", "ends")):
                out[name].append([best[o][i] for o in order])
        return out

    return map_texts(docs, work, [pa.field("n_items", pa.int64()), pa.field("items", pa.list_(_item_type(shared.box.value))),
                                  *(pa.field(n, pa.list_(pa.int64())) for n in ("distances", "starts", "ends"))])


def keep_clean(df, benchmark, share=0.05, text_col="text", item_col="item_id", item_text_col="text", block_chars=BLOCK_CHARS):
    """All columns of the rows whose text holds no item; null texts stay."""
    for items in item_blocks(benchmark, share, item_col, item_text_col, block_chars):
        if items:
            df = _without(df, _Shared(df.sparkSession, items, share), text_col)
    return df


def _without(df, shared, text_col):
    def run(batches):
        for batch in chunks(batches, text=text_col):
            found = shared.get().search(texts_of(batch, text_col))
            yield batch.filter(pa.array([not f for f in found], pa.bool_()))

    return df.mapInArrow(per_task(run), df.schema)
