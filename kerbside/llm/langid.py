"""Language identification by interpolated Kneser-Ney character models, one per language.

Counts of character n-grams are taken over all learning rows by a distributed aggregation, and models are fitted from all
of them, in pieces and as Spark tasks. A model is a set of sorted key arrays, one per order, with the interpolated log-probability of each n-gram and the back-off weight of each
context; lookups are binary searches over the distinct n-grams of a batch. The language with the lowest cross-entropy
per character wins. A text that even its best model finds stranger than practically every learning text is rejected;
the limit is calibrated on learning texts and widens for short ones.
"""

import functools
import pickle
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kerbside.functions.ordered import quantiles
from kerbside.llm.batches import CHUNK_BYTES, chunks, emit, map_texts, per_task, pick, texts_of
from kerbside.llm.bpe import LETTER, classes
from kerbside.llm.wordcache import code_points
from kerbside.session import stage

ORDER = 4
UNKNOWN = "und"
#: Nats a character above the usual that are never held against a text.
LEAST_REACH = 0.5
_BITS = np.uint64(16)


#: The code of a letter beyond the basic plane that no learning row holds.
STRANGE = 0xFFFF


@functools.cache
def spare_codes():
    """The 16-bit codes that stand for no letter of the basic plane."""
    free = np.flatnonzero(classes()[:STRANGE] != LETTER)
    return free[~np.isin(free, (0, 1, 32))]


def narrow(codes, planes):
    """16-bit codes of code points: letters beyond the basic plane get the spare codes, in the order of ``planes``.

    A letter that was never learned from is unlike any learned one, so all of these may share a code.
    """
    far = codes > STRANGE
    if not far.any():
        return codes
    out = np.where(far, STRANGE, codes)
    if len(planes):
        letters = codes[far]
        order = np.argsort(planes)
        at = order[np.minimum(np.searchsorted(planes, letters, sorter=order), len(planes) - 1)]
        out[far] = np.where(planes[at] == letters, spare_codes()[at], STRANGE)
    return out


def far_letters(df, most=None):
    """The letters beyond the basic plane in a table from ``pick``, the most frequent first.

    There are as many spare codes as the basic plane has characters that are no letters, some 16,000. Texts of more
    such letters, which only ideographs are many enough for, have one code for the rarest of them.
    """
    def letters(batches):
        seen = Counter()
        for batch in chunks(batches):
            for text in texts_of(batch):
                codes = code_points(text.lower())
                codes = codes[codes > STRANGE]
                found, n = np.unique(codes[classes()[codes] == LETTER], return_counts=True)
                seen.update(dict(zip(found.tolist(), n.tolist())))
        yield pa.RecordBatch.from_pydict({"letter": pa.array(list(seen), pa.int32()), "n": pa.array(list(seen.values()), pa.int64())})

    rows = df.where(F.col("text").rlike(r"[\x{10000}-\x{10FFFF}]")).select("text").mapInArrow(per_task(letters), "letter int, n long")
    found = rows.groupBy("letter").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "letter").limit(most or len(spare_codes()))
    return np.array([r.letter for r in found.collect()], np.int64)


def stream(texts, planes=()):
    """Letters in lower case with one blank for whatever lies between, each text after ``ORDER - 1`` blanks.

    Returns the n-gram key at every character of a text, the number of the text it belongs to, and the letters of
    each text. A key holds the last ``ORDER`` characters, 16 bits each; see :func:`narrow` for letters that have more.
    """
    mark = np.array([1], np.uint32)
    codes = np.concatenate([x for t in texts for x in (mark, code_points(t.lower()))])
    border = codes == 1
    letter = (classes()[codes] == LETTER) & ~border
    # A text that holds the mark itself: only as many marks count as texts begin.
    begins = np.cumsum([0, *(len(t.lower()) + 1 for t in texts[:-1])])
    border[:] = False
    border[begins] = True
    keep = letter | border
    keep[1:] |= letter[:-1]
    kept = narrow(np.where(letter, codes, 32)[keep], planes).astype(np.uint64)
    border, letter = border[keep], letter[keep]
    kept = np.repeat(kept, np.where(border, ORDER - 1, 1))
    owner = np.repeat(np.cumsum(border) - 1, np.where(border, ORDER - 1, 1))
    blank = np.repeat(border, np.where(border, ORDER - 1, 1))
    keys = np.zeros(len(kept), np.uint64)
    for back in range(ORDER):
        keys[back:] |= kept[:len(kept) - back] << np.uint64(16 * back)
    letters = np.bincount(np.cumsum(border) - 1, weights=letter, minlength=len(texts)).astype(np.int64)
    return keys[~blank], owner[~blank], letters


def count_rows(batches, planes=()):
    """Arrow batches with ``lang, half, text`` to rows ``lang, half, gram, n``, folded within the task."""
    schema = pa.schema([("lang", pa.string()), ("half", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])
    held = {}

    def out():
        for (lang, half), parts in held.items():
            grams, inverse = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
            yield emit(schema, lang=pa.array([lang] * len(grams)), half=np.full(len(grams), half), gram=grams.view(np.int64), n=n)
        held.clear()

    size = 0
    for batch in chunks(batches):
        kinds = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("lang", "half"))))
        texts = texts_of(batch)
        for kind in dict.fromkeys(kinds):
            keys, _, _ = stream([t for t, own in zip(texts, kinds) if own == kind], planes)
            grams, n = np.unique(keys, return_counts=True)
            held.setdefault(kind, []).append((grams, n))
            size += len(grams)
        if size > 4_000_000:
            yield from out()
            size = 0
    yield from out()


@dataclass
class Model:
    """One language: per order the sorted keys with log-probabilities, and sorted contexts with log back-off weights."""

    keys: list
    logs: list
    contexts: list
    weights: list
    floor: float

    def log_probability(self, grams):
        """Natural logs for sorted keys of the highest order."""
        out = np.zeros(len(grams))
        todo = np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            mask = np.uint64((1 << (16 * order)) - 1)
            key = grams[todo] & mask
            at = np.minimum(np.searchsorted(self.keys[order], key), len(self.keys[order]) - 1)
            found = self.keys[order][at] == key
            out[todo[found]] += self.logs[order][at[found]]
            todo, key = todo[~found], key[~found]
            if not len(todo):
                return out
            context = key >> _BITS
            at = np.minimum(np.searchsorted(self.contexts[order], context), len(self.contexts[order]) - 1)
            seen = self.contexts[order][at] == context
            out[todo[seen]] += self.weights[order][at[seen]]
        out[todo] += self.floor
        return out


def discount_of(ones, twos):
    """The absolute discount of one order, from how many of its n-grams have counts of one and of two."""
    return min(0.95, max(0.1, ones / (ones + 2 * twos) if ones else 0.5))


def kneser_ney(grams, n, alphabet=256, unigrams=None, discounts=None):
    """The interpolated model of one language from its distinct highest-order n-grams and their counts.

    With ``unigrams`` (keys and continuation counts) and ``discounts`` by order, both of the whole language, ``grams``
    may be a part of it that holds all n-grams of some last character but one: whatever orders 2 and up need has the
    same one, so the parts together equal the model of the whole.
    """
    keys, counts = [None] * (ORDER + 1), [None] * (ORDER + 1)
    order = np.argsort(grams)
    keys[ORDER], counts[ORDER] = grams[order], n[order].astype(float)
    for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct characters before
        keys[k], c = np.unique(keys[k + 1] & np.uint64((1 << (16 * k)) - 1), return_counts=True)
        counts[k] = c.astype(float)
    if unigrams is not None:
        keys[1], counts[1] = unigrams
    floor = 1.0 / (len(keys[1]) + alphabet)
    probability, logs, contexts, weights = [None] * (ORDER + 1), [None] * (ORDER + 1), [None] * (ORDER + 1), [None] * (ORDER + 1)
    for k in range(1, ORDER + 1):
        discount = discounts[k] if discounts else discount_of((counts[k] == 1).sum(), (counts[k] == 2).sum())
        contexts[k], first, inverse = np.unique(keys[k] >> _BITS, return_index=True, return_inverse=True)
        total, kinds = np.bincount(inverse, weights=counts[k]), np.bincount(inverse)
        weight = discount * kinds / total
        if k == 1:
            lower = floor
        else:
            short = np.searchsorted(keys[k - 1], keys[k] & np.uint64((1 << (16 * (k - 1))) - 1))
            lower = probability[k - 1][short]
        probability[k] = (counts[k] - discount) / total[inverse] + weight[inverse] * lower
        logs[k], weights[k] = np.log(probability[k]), np.log(weight)
    return Model(keys, logs, contexts, weights, float(np.log(floor)))


def _merged(models):
    """One model from parts of the same language; all have its unigrams."""
    if len(models) == 1:
        return models[0]
    out = Model([None], [None], [None], [None], models[0].floor)
    for names in (("keys", "logs"), ("contexts", "weights")):
        for k in range(1, ORDER + 1):
            key, value = (np.concatenate([getattr(m, n)[k] for m in (models if k > 1 else models[:1])]) for n in names)
            order = np.argsort(key)
            for n, x in zip(names, (key, value)):
                getattr(out, n).append(x[order])
    return out


@dataclass
class Identifier:
    """Models by language and the calibrated limits: usual cross-entropy and how far a text may lie above it.

    A block is a broadcast list of ``(language number, the last characters but one that the model is for, model)``;
    of several blocks one at a time is in memory. A language without calibration rows has an infinite usual
    cross-entropy: nothing is rejected for it.
    """

    names: list
    blocks: list
    usual: dict
    reach: float = float("inf")
    planes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def entropies(self, texts):
        """Cross-entropies ``[text, language]`` in nats a character, characters and letters of each text."""
        keys, owner, letters = stream(texts, self.planes)
        grams, inverse = np.unique(keys, return_inverse=True)
        size = np.bincount(owner, minlength=len(texts))
        middle = (grams >> _BITS & np.uint64(0xFFFF)).astype(np.int64)
        out = np.zeros((len(texts), len(self.names)))
        for block in self.blocks:
            for j, covers, model in block.value:
                logs, own = np.zeros(len(grams)), covers[middle]
                logs[own] = model.log_probability(grams[own])
                out[:, j] -= np.bincount(owner, weights=logs[inverse], minlength=len(texts))
            if len(self.blocks) > 1:
                vars(block).pop("_value", None)
        return out / np.maximum(size, 1)[:, None], size, letters

    def chunk_bytes(self):
        """Bytes of text to score at once; more when every chunk loads the blocks anew."""
        return CHUNK_BYTES * (4 if len(self.blocks) > 1 else 1)

    def excess(self, best, value, size):
        """How far the cross-entropy lies above the usual one, in units that allow more for short texts."""
        usual = np.array(list(self.usual.values()))
        return (value - usual[best]) / (1 + 20 / np.maximum(size, 1))

    def predict(self, texts):
        """``(languages, scores, rejected)``; the score is the posterior of the winner under a root-of-length scale."""
        if not texts or not self.names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        entropy, size, letters = self.entropies(texts)
        best = entropy.argmin(axis=1)
        value = entropy[np.arange(len(texts)), best]
        score = 1 / np.exp((value[:, None] - entropy) * np.sqrt(np.maximum(size, 1))[:, None]).sum(axis=1)
        strange = self.excess(best, value, size) > self.reach
        none = letters == 0
        return ([UNKNOWN if n else self.names[b] for n, b in zip(none, best)], np.where(none, 0.0, score).tolist(), (none | strange).tolist())


def _levels(counts):
    """n-grams of every order as ``lang, k, gram, n, m``: counts of the highest order, continuation counts below it."""
    out = {ORDER: counts.select("lang", F.lit(ORDER).alias("k"), "gram", "n", "m")}
    for k in range(ORDER - 1, 0, -1):
        short = F.col("gram").bitwiseAND(F.lit((1 << (16 * k)) - 1)).alias("gram")
        out[k] = stage(out[k + 1].groupBy("lang", short).agg(F.count("*").alias("n"), F.count_if(F.col("m") > 0).alias("m"))
                       .select("lang", F.lit(k).alias("k"), "gram", "n", "m"), "grams")
    return out


def _fitter(unigrams, discounts):
    """The models of a part of a language, of all rows (half -1) and of the first half (0)."""
    def run(keys, table):
        lang, grams = table.column("lang")[0].as_py(), table.column("gram").to_numpy().view(np.uint64)
        halves, blobs = [], []
        for half, name in ((-1, "n"), (0, "m")):
            n = table.column(name).to_numpy()
            if (n > 0).any():
                halves.append(half)
                blobs.append(pickle.dumps(kneser_ney(grams[n > 0], n[n > 0], unigrams=unigrams[lang, half], discounts=discounts[lang, half])))
        return pa.table({"piece": pa.array([keys[0].as_py()] * len(halves), pa.int32()), "half": pa.array(halves, pa.int32()), "model": pa.array(blobs, pa.binary())})
    return run


def fit(counts, piece_grams, block_grams):
    """Identifiers without limits, of all rows and of the first half, from ``lang, gram, n, m`` (a staged table).

    Discounts and unigrams are aggregates over all counts. Everything else of a model needs only n-grams of the same
    last character but one, so languages are cut by it into pieces of about ``piece_grams``, which are fitted as tasks
    of their own. Pieces are packed to blocks of about ``block_grams``; one block at a time comes to the driver.
    """
    spark = counts.sparkSession
    middle = F.shiftright("gram", 16).bitwiseAND(F.lit(0xFFFF)).cast("int").alias("middle")
    cells = counts.groupBy("lang", middle).agg(F.count("*").alias("size")).toArrow().sort_by([("lang", "ascending"), ("middle", "ascending")])
    langs, middles, sizes = cells.column("lang").to_pylist(), cells.column("middle").to_numpy(), cells.column("size").to_numpy()
    names = list(dict.fromkeys(langs))
    if not names:
        return Identifier([], [], {}), Identifier([], [], {})
    pieces, members = np.zeros(len(langs), np.int32), []  # per piece: language, size, cells
    for i, (lang, size) in enumerate(zip(langs, sizes.tolist())):
        if not members or members[-1][0] != lang or members[-1][1] + size > piece_grams:
            members.append([lang, 0, []])
        members[-1][1] += size
        members[-1][2].append(i)
        pieces[i] = len(members) - 1
    blocks, room = [], 0
    for p, (_, size, _) in enumerate(members):
        if not blocks or size > room:
            blocks.append([])
            room = block_grams
        blocks[-1].append(p)
        room -= size
    levels = _levels(counts)
    kinds = [F.count_if(F.col(c) == v).alias(f"{c}{v}") for c in "nm" for v in (1, 2)]
    several = levels[1]
    for k in range(2, ORDER + 1):
        several = several.unionByName(levels[k])
    seen = {(r.lang, r.k): r for r in several.groupBy("lang", "k").agg(*kinds).collect()}
    discounts = {(g, h): [None, *(discount_of(seen[g, k][f"{c}1"], seen[g, k][f"{c}2"]) for k in range(1, ORDER + 1))] for g in names for h, c in ((-1, "n"), (0, "m"))}
    letters = levels[1].toArrow().sort_by("gram")
    owner, unigrams = np.array(letters.column("lang").to_pylist(), object), {}
    for g in names:
        key = letters.column("gram").to_numpy()[owner == g].view(np.uint64)
        for h, c in ((-1, "n"), (0, "m")):
            n = letters.column(c).to_numpy()[owner == g].astype(float)
            unigrams[g, h] = (key[n > 0], n[n > 0])
    where = spark.createDataFrame(pa.table({"lang": cells.column("lang"), "middle": middles, "piece": pieces}))
    placed = counts.withColumn("middle", middle).join(where, ["lang", "middle"]).select("piece", "lang", "gram", "n", "m")
    fitted = stage(placed.groupBy("piece").applyInArrow(_fitter(unigrams, discounts), "piece int, half int, model binary"), "models")
    made = {(r.piece, r.half) for r in fitted.select("piece", "half").collect()}
    return tuple(_ship(spark, fitted, names, members, middles, blocks, half, made) for half in (-1, 0))


def _ship(spark, fitted, names, members, middles, blocks, half, made):
    """The fitted pieces of one half as an identifier; one block at a time is in the driver's memory."""
    cover, known = {}, []
    for p, (g, _, cells) in enumerate(members):
        if (p, half) in made:
            cover[p] = np.zeros(1 << 16, bool)
            cover[p][middles[cells]] = True
            known += [] if known[-1:] == [g] else [g]
    for g in known:  # what a language has never seen as the last character but one falls to its unigrams, in any one piece
        own = [cover[p] for p in cover if members[p][0] == g]
        own[0] |= ~np.logical_or.reduce(own)
    sent = []
    for block in blocks:
        rows = fitted.where((F.col("half") == half) & F.col("piece").between(block[0], block[-1])).toArrow().sort_by("piece")
        held = {}
        for p, blob in zip(rows.column("piece").to_pylist(), rows.column("model").to_pylist()):
            held.setdefault(members[p][0], []).append((cover[p], pickle.loads(blob)))
        if held:
            sent.append(spark.sparkContext.broadcast([(known.index(g), np.logical_or.reduce([c for c, _ in own]), _merged([m for _, m in own])) for g, own in held.items()]))
    return Identifier(known, sent, dict.fromkeys(known, float("inf")))


def train(df, reject=0.0005, slack=1.5, piece_grams=500_000, block_grams=4_000_000, id_col="doc_id", text_col="text", lang_col="lang"):
    """Learn from all rows with a text and a language.

    n-gram counts and models cover every row and every n-gram; see :func:`fit` for the bounds, which change what is
    held at once and not the models. The limit of rejection comes from models of one half of the rows, by the hash of
    their id, and all rows of the other: a language's usual cross-entropy is the median of the rows that it wins, of 50
    characters and more where there are any; a share ``reject`` of the rows lies beyond the limit, and it is then
    widened by ``slack``. A language that wins none of these rows has no limit, so nothing is rejected for it.
    """
    spark = df.sparkSession
    rows = pick(df, id_col, text_col, lang=lang_col).where("text IS NOT NULL AND lang IS NOT NULL")
    half = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2)).cast("int")
    planes = far_letters(rows)
    counts = rows.select("lang", half.alias("half"), "text").mapInArrow(per_task(functools.partial(count_rows, planes=planes)), "lang string, half int, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("half") == 0, F.col("n")).otherwise(0)).alias("m"))
    found, first = fit(stage(counts, "counts"), piece_grams, block_grams)
    found.planes = first.planes = planes
    if not first.names:
        return found
    at = np.array([found.names.index(g) for g in first.names])

    def figures(batches):
        for batch in chunks(batches, first.chunk_bytes()):
            entropy, size, letters = first.entropies(texts_of(batch))
            best = entropy.argmin(axis=1)
            use = letters > 0
            yield pa.RecordBatch.from_pydict({"best": at[best[use]], "value": entropy[np.arange(len(best)), best][use], "size": size[use]})

    seen = stage(rows.where(half == 1).select("text").mapInArrow(per_task(figures), "best long, value double, size long"), "entropies")
    for block in first.blocks:
        block.destroy()
    for some in (seen, seen.where("size >= 50")):
        for r in quantiles(some, "value", {"usual": 0.5}, by=["best"]).collect():
            found.usual[found.names[r.best]] = r.usual
    usual = spark.createDataFrame([(j, u) for j, u in enumerate(found.usual.values()) if u < float("inf")], "best long, usual double")
    excess = seen.join(F.broadcast(usual), "best").select(((F.col("value") - F.col("usual")) / (1 + 20 / F.greatest("size", F.lit(1)))).alias("excess"))
    limit = quantiles(excess, "excess", {"limit": 1 - reject}).first()
    if limit is not None and limit[0] is not None:
        found.reach = float(max(limit[0], LEAST_REACH) * slack)
    return found


def identify(df, identifier, id_col="doc_id", text_col="text"):
    """``doc_id``, ``lang_pred``, ``score`` (0 to 1), ``rejected``; one row per row.

    Null, empty and letterless texts are ``und`` with score 0 and rejected; of equal cross-entropies the first
    language by name wins; without a learned language all is ``und``. No other column is read; no shuffle.
    """
    def work(batch):
        langs, scores, rejected = identifier.predict(texts_of(batch))
        return {"lang_pred": langs, "score": scores, "rejected": rejected}

    fields = [pa.field("lang_pred", pa.string()), pa.field("score", pa.float64()), pa.field("rejected", pa.bool_())]
    return map_texts(pick(df, id_col, text_col), work, fields, identifier.chunk_bytes())


def keep_identified(df, identifier, text_col="text"):
    """All columns of the rows whose text is not rejected."""
    def run(batches):
        for batch in chunks(batches, identifier.chunk_bytes(), text=text_col):
            yield batch.filter(pa.array(~np.array(identifier.predict(texts_of(batch, text_col))[2], bool)))

    return df.mapInArrow(per_task(run), df.schema)


def learning_rows(df, id_col="doc_id"):
    """The rows that may be learned from: those whose ``crc32`` of the id as text is not 1 modulo 3."""
    return df.where(F.crc32(F.col(f"`{id_col}`").cast("string")) % 3 != 1)
