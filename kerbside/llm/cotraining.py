"""Quality scores by co-training: a classifier of the text and one of the metadata teach each other.

Each view is a naive Bayes classifier over counts of features per class, so what it learns is a sum over documents, and
Spark can take the sum. Labelled rows start both views. In each round all unlabelled documents of the table are scored
by both; whatever one view is sure of is handed to the other, which adds the document's features to its counts. A view's
probability is calibrated on labelled rows that it never learns from; a view that is sure of nothing hands over nothing.
At the end the two calibrated views are combined by a regression on labelled rows that served for neither.

A text is its distinct lower-case words, hashed, and layout figures in steps; metadata are exact values, numbers by
their binary magnitude, hashed to a space in which few meet.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kerbside.llm.batches import chunks, map_texts, per_task, pick, texts_of
from kerbside.llm.wordcache import piece_hashes

#: Hashed words, layout figures and their steps, hashed metadata values.
WORDS, FIGURES, STEPS, VALUES = 1 << 14, 9, 16, 1 << 16
TEXT = WORDS + FIGURES * STEPS


@dataclass
class Bags:
    """The features of some documents: the row and the number of each feature, every one once, by row."""

    rows: np.ndarray
    at: np.ndarray
    n: int
    size: int

    def of(self, chosen):
        """The bags of the documents that a boolean array marks."""
        use = chosen[self.rows]
        return Bags((np.cumsum(chosen) - 1)[self.rows[use]], self.at[use], int(chosen.sum()), self.size)

    def counts(self, weight=None):
        return np.bincount(self.at, weights=None if weight is None else weight[self.rows], minlength=self.size)


def text_bags(texts):
    """Distinct hashed lower-case words and stepped layout figures of whole texts."""
    raw = [t.encode() for t in texts]
    begins = np.cumsum([0, *(len(r) + 1 for r in raw)])
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    share = np.zeros((len(texts), FIGURES))
    words_at = np.zeros(0, np.uint64)
    if len(data) > len(texts):
        upper, lower = (data >= 65) & (data <= 90), ((data >= 97) & (data <= 122)) | (data >= 128)
        digit, line, blank = (data >= 48) & (data <= 57), data == 10, (data == 32) | ((data >= 9) & (data <= 13))
        stop = np.isin(data, np.frombuffer(b".,;:?'\"-()", np.uint8))
        symbol = ~(upper | lower | digit | blank | stop)
        count = lambda m: np.diff(np.r_[0, np.cumsum(m)][begins])
        size = np.maximum(1, np.diff(begins) - 1)
        plain = data | (upper.astype(np.uint8) << 5)
        edge = np.diff(np.concatenate([[False], ~blank, [False]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        owner = np.searchsorted(begins, starts, "right") - 1
        words = np.bincount(owner, minlength=len(texts))
        for k, value in enumerate((count(upper), count(lower), count(digit), count(symbol), count(stop), count(blank))):
            share[:, k] = value / size
        share[:, 6] = size / np.maximum(1, words) / 20
        share[:, 7] = count(line) / np.maximum(1, words)
        if len(starts):
            hashes = piece_hashes(plain, starts, ends)
            full = np.unique(owner.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24))
            share[:, 8] = np.bincount((full >> np.uint64(40)).astype(np.int64), minlength=len(texts)) / np.maximum(1, words)
            words_at = np.unique(owner.astype(np.uint64) << np.uint64(32) | hashes % np.uint64(WORDS))
    # The root tells small shares apart.
    steps = np.minimum(STEPS - 1, STEPS * np.sqrt(np.clip(share, 0, 1))).astype(np.int64)
    figures = WORDS + np.arange(FIGURES) * STEPS + steps
    rows = np.r_[(words_at >> np.uint64(32)).astype(np.int64), np.repeat(np.arange(len(texts)), FIGURES)]
    at = np.r_[(words_at & np.uint64(0xFFFFFFFF)).astype(np.int64), figures.ravel()]
    order = np.argsort(rows, kind="stable")
    return Bags(rows[order], at[order], len(texts), TEXT)


def meta_bags(columns, n):
    """Hashed values of the metadata, in a range of their own for each; ``columns`` maps names to lists of ``n`` values."""
    at = np.zeros((n, len(columns)), np.int64)
    for k, (name, values) in enumerate(columns.items()):
        seen = {}
        for i, value in enumerate(values):
            known = seen.get(value)
            if known is None:
                kind = f"#{int(abs(value)).bit_length()}" if isinstance(value, (int, float)) and not isinstance(value, bool) and value == value and abs(value) < 2.0**62 else str(value)
                code = np.frombuffer(f"{name}={kind}".encode(), np.uint8)
                known = seen[value] = int(piece_hashes(code, np.array([0]), np.array([len(code)]))[0] % np.uint64(VALUES))
            at[i, k] = k * VALUES + known
    return Bags(np.repeat(np.arange(n), len(columns)), at.ravel(), n, VALUES * len(columns))


def logistic(x, y, prior=0.1, rounds=60):
    """Weights of a logistic regression on a few columns; the last weight is the bias.

    Newton's method with halved steps under a normal prior on the weights of the standardised columns, so that few or
    separable rows give moderate weights.
    """
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    w, hold = np.zeros(z.shape[1]), prior * np.r_[np.ones(z.shape[1] - 1), 1e-3]
    loss = lambda w: np.logaddexp(0, np.where(y > 0, -1, 1) * (z @ w)).sum() + (hold * w * w).sum() / 2
    for _ in range(rounds):
        p = sigmoid(z @ w)
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(hold), z.T @ (y - p) - hold * w)
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return np.r_[w[:-1] / spread, w[-1] - mean @ (w[:-1] / spread)]


def logit(x, w):
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class View:
    """Feature counts per class, and how their evidence becomes a probability."""

    counts: np.ndarray  # class x feature
    words: int  # features below this number are a document's words, the others its single features
    span: int  # features of one kind among the single ones
    calibration: np.ndarray = None
    weights: np.ndarray = None

    def learn(self):
        """Log odds of the features, words against all words and single features against all single ones."""
        odds = np.zeros_like(self.counts)
        for part in (slice(0, self.words), slice(self.words, None)):
            smooth = self.counts[:, part] + 0.5
            odds[:, part] = np.log(smooth / smooth.sum(axis=1, keepdims=True)) if smooth.size else 0
        self.weights = odds[1] - odds[0]

    def evidence(self, bags):
        """The log odds of a document, a column for each kind of single feature and one for the mean of its words.

        Kinds hang together, so the calibration weighs them instead of adding them up.
        """
        own, word = self.weights[bags.at], bags.at < self.words
        kinds = (bags.size - self.words) // self.span
        cell = bags.rows[~word] * kinds + (bags.at[~word] - self.words) // self.span
        single = np.bincount(cell, weights=own[~word], minlength=bags.n * kinds).reshape(bags.n, kinds)
        if not self.words:
            return single
        mean = np.bincount(bags.rows[word], weights=own[word], minlength=bags.n) / np.maximum(1, np.bincount(bags.rows[word], minlength=bags.n))
        return np.c_[single, mean]

    def calibrate(self, bags, y):
        self.learn()
        self.calibration = logistic(self.evidence(bags), y)

    def logits(self, bags):
        return logit(self.evidence(bags), self.calibration)


@dataclass
class CoTrained:
    """The two views and the weights of their combination; without views the base rate is all that is known."""

    text: View = None
    meta: View = None
    join: np.ndarray = None
    base: float = 0.5
    given: list = field(default_factory=list)

    def score(self, text, meta):
        if self.text is None:
            return np.full(text.n, self.base)
        return sigmoid(logit(np.c_[self.text.logits(text), self.meta.logits(meta)], self.join))


def handed_over(views, bags, sure):
    """What each view is sure of, for the other: ``[(labels, chosen)]`` for the text view and the metadata view."""
    out = []
    for view, own in zip(views, bags):
        p = sigmoid(view.logits(own))
        out.append(((p >= 0.5).astype(np.int64), np.maximum(p, 1 - p) >= sure))
    return out


def co_train(text, meta, y, gather, rounds=3, sure=0.97, pseudo=0.5):
    """Fit both views on ``y`` (0 or 1) and, round by round, on what the other is ``sure`` of among unlabelled documents.

    ``gather(views, sure)`` adds up, over all unlabelled documents, the features of those that the other view is sure of:
    ``[(class counts, documents)]`` for the text view and the metadata view. They weigh ``pseudo`` as much as labelled
    ones and are taken anew in every round. Half of the labelled rows are learned from, a quarter calibrates the views,
    a quarter combines them.
    """
    y = np.asarray(y, np.int64)
    base = float(y.mean()) if len(y) else 0.5
    turn = np.arange(len(y)) % 4
    use = [turn % 2 == 0, turn == 1, turn == 3]  # to learn, to calibrate, to combine
    if len(y) < 16 or any(len(set(y[u].tolist())) < 2 for u in use):
        return CoTrained(base=base)
    own = (text, meta)
    known = [np.stack([b.of(use[0] & (y == c)).counts() for c in (0, 1)]).astype(float) for b in own]
    views, given = [View(known[0], WORDS, STEPS), View(known[1], 0, VALUES)], []
    for step in range(rounds + 1):
        for view, b in zip(views, own):
            view.calibrate(b.of(use[1]), y[use[1]])
        if step == rounds:
            break
        added = gather(views, sure)
        # How many documents the metadata view gave the text view, and the other way round.
        given.append(tuple(n for _, n in added))
        if not any(given[-1]):
            break
        for k in range(2):
            views[k].counts = known[k] + pseudo * added[k][0]
    z = np.c_[views[0].logits(text.of(use[2])), views[1].logits(meta.of(use[2]))]
    return CoTrained(views[0], views[1], logistic(z, y[use[2]]), base, given)


def summed(views, bags, sure):
    """The sums of :func:`co_train` over some documents, each view's from what the other is sure of."""
    sides = handed_over(views, bags, sure)
    out = []
    for k in range(2):
        labels, chosen = sides[1 - k]
        out.append((np.stack([bags[k].of(chosen & (labels == c)).counts() for c in (0, 1)]), int(chosen.sum())))
    return out


def _views(batch, meta):
    texts = texts_of(batch)
    columns = {c: batch.column(batch.schema.get_field_index(f"meta_{c}")).to_pylist() for c in meta}
    return text_bags(texts), meta_bags(columns, len(texts))


def train(df, labels, meta=("source", "lang", "n_chars"), sample=4000, rounds=3, sure=0.97, id_col="doc_id", text_col="text", label_col="quality"):
    """A classifier from at most ``sample`` labelled documents, by the hash of their id, and all unlabelled ones.

    Every round reads the whole table. What comes to the driver is the features of the sample and, per round, counts
    per feature, summed by Spark. Labels that are null or neither 0 nor 1, and null ids, are not used; an id with
    several labels takes the least; every row of a labelled id is left out of the unlabelled. Without both classes the
    base rate is all that is learned; rows of equal texts and metadata count each.
    """
    docs = pick(df, id_col, text_col, **{f"meta_{c}": c for c in meta}).where("doc_id IS NOT NULL")
    marks = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)")
    marks = marks.groupBy("doc_id").agg(F.min("y").alias("y"))
    chosen = docs.select("doc_id").distinct().join(marks, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    wanted = {r.doc_id: r.y for r in chosen.collect()}
    if not wanted:
        return CoTrained()
    kept = df.sparkSession.createDataFrame(list(wanted), docs.schema["doc_id"].dataType).toDF("doc_id")

    def rows(batches):
        for batch in chunks(batches):
            found = _views(batch, meta)
            cuts = [np.cumsum(np.bincount(b.rows, minlength=b.n))[:-1] for b in found]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(batch.schema.get_field_index("doc_id")),
                **{name: pa.array([x.astype(np.int32).tobytes() for x in np.split(b.at, cut)], pa.binary()) for name, b, cut in zip(("text", "meta"), found, cuts)}})

    schema = docs.select("doc_id", F.lit(b"").alias("text"), F.lit(b"").alias("meta")).schema
    # At most the sample: a checked broadcast on both sides of the table.
    found = docs.join(F.broadcast(kept), "doc_id", "left_semi").mapInArrow(per_task(rows), schema).collect()
    found.sort(key=lambda r: (wanted[r.doc_id], bytes(r.text), bytes(r.meta)))  # the same whatever order rows arrive in
    y = np.array([wanted[r.doc_id] for r in found])

    def bags(name, size):
        held = [np.frombuffer(r[name], np.int32) for r in found]
        return Bags(np.repeat(np.arange(len(held)), [len(h) for h in held]), np.concatenate(held).astype(np.int64), len(held), size)

    free = docs.join(F.broadcast(kept), "doc_id", "left_anti")

    def gather(views, sure):
        def add(batches):
            total = None
            for batch in chunks(batches):
                part = summed(views, _views(batch, meta), sure)
                total = part if total is None else [(a + c, n + m) for (a, n), (c, m) in zip(total, part)]
            for k, (counts, n) in enumerate(total or []):
                which, at = np.nonzero(counts)
                yield pa.RecordBatch.from_pydict({
                    "view": pa.array(np.full(len(at) + 1, k), pa.int32()), "class": pa.array(np.r_[which, -1], pa.int32()),
                    "feature": pa.array(np.r_[at, 0], pa.int64()), "n": pa.array(np.r_[counts[which, at], n].astype(np.int64))})

        sums = free.mapInArrow(per_task(add), "view int, class int, feature long, n long").groupBy("view", "class", "feature").agg(F.sum("n").alias("n"))
        table = sums.toArrow()  # as many rows as features at most
        view, kind, at, n = (table.column(c).to_numpy() for c in ("view", "class", "feature", "n"))
        out = []
        for k, size in enumerate((TEXT, VALUES * len(meta))):
            counts, use = np.zeros((2, size)), (view == k) & (kind >= 0)
            counts[kind[use], at[use]] = n[use]
            out.append((counts, int(n[(view == k) & (kind < 0)].sum())))
        return out

    return co_train(bags("text", TEXT), bags("meta", VALUES * len(meta)), y, gather, rounds, sure)


def score(df, model, meta=("source", "lang", "n_chars"), least=0.5, id_col="doc_id", text_col="text"):
    """``doc_id``, ``score`` (0 to 1), ``keep`` (score at least ``least``) of every row.

    Null and empty texts are scored by their layout figures of zero and their metadata; null metadata is a value of its
    own; no other column is read. No shuffle; memory bounded by a chunk of texts.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(batch):
        found = shared.value.score(*_views(batch, meta))
        return {"score": found, "keep": found >= least}

    return map_texts(pick(df, id_col, text_col, **{f"meta_{c}": c for c in meta}), work, [pa.field("score", pa.float64()), pa.field("keep", pa.bool_())])
