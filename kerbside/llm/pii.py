"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes for other forms.

The patterns give the base spans. The field is trained from a small labelled table: windows around pattern matches of a
bounded sample of the texts that have any, by kind, the same windows with the values written in another form, and clean
windows. A sequence is a stretch of a line: every token that holds a digit, an ``@`` or a spelled-out dot, and the
``REACH`` tokens to either side, stretches that touch being one. What lies further from any such token is outside. A
token is known by its own shape and by the words around it. Viterbi decodes sequences together in numpy batches.

What the field adds must still be what its kind says: a card number passes its check sum, an address keeps to its
ranges, a phone number to its digits.
"""

import hashlib
import random
import re
import zlib
from dataclasses import dataclass
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kerbside.llm.batches import chunks, map_texts, per_task, pick, texts_of
from kerbside.session import stage

# The kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never begins inside a run of digits, so the look-behind changes nothing but the time.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@]")
TOKEN = re.compile(r"\S+")
#: A dot that is written out, alone or in brackets, between other tokens.
SPELLED = re.compile(r"(?<!\S)[\[({]?(?:dot|DOT|Dot)[\])}]?(?!\S)")

#: Tokens to either side of a marked one that belong to its sequence.
REACH = 4

LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]


def luhn(digits):
    """The check sum of card numbers."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text):
    """Matches of the mail pattern in time linear in the text, from each ``@`` outwards."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        free = at + 1
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", free)


def base_spans(text):
    """``[(kind, start, end)]`` by kind, then start; leftmost, not overlapping within a kind."""
    if not MARK.search(text):
        return []
    out = [("email", a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def written(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def shape(token):
    """Runs of digits become their length, letters collapse, other characters stay."""
    out = re.sub(r"[0-9]+", lambda m: f"9{min(m.end() - m.start(), 20)}", token)
    out = re.sub(r"[A-Z]*[a-z]+", "a", out)
    return re.sub(r"[A-Z]+", "A", out)


def features(token):
    """Names of the word-shape features of a token."""
    core = token.strip(".,;:!?\"'#$%&*")
    digits = sum(c.isdigit() for c in core)
    loose = re.sub(r"9[0-9]+", "9", shape(core))
    out = ["bias", "shape=" + shape(core), "loose=" + loose, "rough=" + re.sub(r"(.)\1+", r"\1", re.sub("[aA9]+", "x", loose)),
           f"digits={min(digits, 20)}", f"share={digits * 4 // max(1, len(core))}", f"first={shape(core[:1])[:1]}", f"last={shape(core[-1:])[:1]}"]
    out += [f"has={c}" for c in "@.-+():/_" if c in core]
    if core != token:
        out.append("edge")
    return out


def word(token):
    """What a token is to its neighbours: its letters in lower case, or its shape if it has none."""
    letters = re.sub(r"[^a-z]+", "", token.lower())
    return letters or shape(token)


def marked(text):
    return bool(MARK.search(text) or SPELLED.search(text))


def stretches(text):
    """The sequences of a text: ``[[(start, end), ...], ...]``."""
    out, at = [], 0
    for line in text.split("\n"):
        if marked(line):
            tokens = [m.span() for m in TOKEN.finditer(line)]
            last = -1
            for i, (a, b) in enumerate(tokens):
                token = line[a:b]
                if not (MARK.search(token) or SPELLED.fullmatch(token)):
                    continue
                first, end = max(0, i - REACH), min(len(tokens), i + REACH + 1)
                if first > last:
                    out.append([])
                    last = first
                out[-1] += [(at + x, at + y) for x, y in tokens[last:end]]
                last = max(last, end)
        at += len(line) + 1
    return out


#: The neighbours that a token is known by.
AROUND = (("before", -1), ("before2", -2), ("after", 1))


def all_features(tokens):
    """The features of every token of a sequence, its neighbours among them."""
    words = [word(t) for t in tokens]
    near = lambda j: words[j] if 0 <= j < len(words) else ""
    return [features(t) + [f"{name}={near(j + step)}" for name, step in AROUND] for j, t in enumerate(tokens)]


@dataclass(frozen=True)
class Crf:
    """Weights of a trained field: ``emit[feature, label]``, ``move[label, label]``, ``begin[label]``."""

    names: dict
    emit: np.ndarray
    move: np.ndarray
    begin: np.ndarray

    def scores(self, sequences):
        """Padded emission scores ``[sequence, position, label]`` and the lengths."""
        lengths = np.array([len(s) for s in sequences])
        numbers, distinct = np.full((len(sequences), lengths.max()), -1, np.int64), {}
        for i, s in enumerate(sequences):
            numbers[i, :len(s)] = [distinct.setdefault(t, len(distinct)) for t in s]
        weigh = lambda names: self.emit[[self.names[f] for f in names if f in self.names]].sum(axis=0)
        own = np.array([weigh(features(t)) for t in distinct])
        out = np.where((numbers >= 0)[:, :, None], own[numbers], 0.0)
        words = [word(t) for t in distinct]
        for name, step in AROUND:
            # The last row stands for the end of a sequence.
            beside = np.array([weigh([f"{name}={w}"]) for w in (*words, "")])
            shifted = np.full_like(numbers, -1)
            if step < 0:
                shifted[:, -step:] = numbers[:, :step]
            else:
                shifted[:, :-step] = numbers[:, step:]
            out += np.where((numbers >= 0)[:, :, None], beside[shifted], 0.0)
        return out, lengths

    def viterbi(self, sequences):
        """The best labels of each sequence of tokens, all sequences of a batch at once."""
        if not sequences:
            return []
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        out = [None] * len(sequences)
        at = 0
        while at < len(order):  # batches of like lengths, bounded in padded size
            width, end = len(sequences[order[at]]), at
            while end < len(order) and (end - at + 1) * len(sequences[order[end]]) <= max(65_536, width):
                end += 1
            block = order[at:max(end, at + 1)]
            for i, labels in zip(block, self._viterbi([sequences[i] for i in block])):
                out[i] = labels
            at = max(end, at + 1)
        return out

    def _viterbi(self, sequences):
        emit, lengths = self.scores(sequences)
        n, width, _ = emit.shape
        best = self.begin + emit[:, 0]
        back = np.zeros((n, width, len(LABELS)), np.int8)
        for j in range(1, width):
            through = best[:, :, None] + self.move
            back[:, j] = through.argmax(axis=1)
            step = through.max(axis=1) + emit[:, j]
            best = np.where((lengths > j)[:, None], step, best)
        label = best.argmax(axis=1)
        path = np.zeros((n, width), np.int64)
        for j in range(width - 1, -1, -1):
            path[:, j] = label
            inside = lengths > j
            label = np.where(inside & (j > 0), back[np.arange(n), j, label], label)
        return [p[:k] for p, k in zip(path, lengths)]


def fit(labelled, rounds=120, rate=0.15, decay=1e-3, least=2):
    """Train by gradient ascent on the conditional likelihood. ``labelled``: ``[(tokens, labels), ...]``, small.

    Features seen fewer than ``least`` times are left out. None when nothing but outside is labelled.
    """
    labelled = [(t, y) for t, y in labelled if t]
    if not any(any(y) for _, y in labelled):
        return None
    seen, described = {}, [all_features(tokens) for tokens, _ in labelled]
    for own in described:
        for names in own:
            for f in names:
                seen[f] = seen.get(f, 0) + 1
    names = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= least))}
    n, width, k = len(labelled), max(len(t) for t, _ in labelled), len(LABELS)
    mask = np.zeros((n, width), bool)
    gold = np.zeros((n, width), np.int64)
    rows, cols = [], []
    for i, (tokens, y) in enumerate(labelled):
        mask[i, :len(tokens)] = True
        gold[i, :len(y)] = y
        for j, own in enumerate(described[i]):
            for f in own:
                if f in names:
                    rows.append(i * width + j)
                    cols.append(names[f])
    rows, cols = np.array(rows), np.array(cols)
    order = np.argsort(rows, kind="stable")
    rows, cols = rows[order], cols[order]
    filled, begins = np.unique(rows, return_index=True)
    turned = np.argsort(cols, kind="stable")
    by_name, name_begins = rows[turned], np.unique(cols[turned], return_index=True)[1]
    theta = [np.zeros((len(names), k)), np.zeros((k, k)), np.zeros(k)]
    for p in range(1, k):  # an inside label follows only its own kind
        if LABELS[p][0] == "I":
            theta[2][p] = -8.0
            theta[1][[q for q in range(k) if LABELS[q][2:] != LABELS[p][2:]], p] = -8.0
    start = [t.copy() for t in theta]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    one_hot = np.eye(k)[gold] * mask[:, :, None]
    for step in range(1, rounds + 1):
        emit = np.zeros((n * width, k))
        emit[filled] = np.add.reduceat(theta[0][cols], begins, axis=0)
        emit = emit.reshape(n, width, k)
        forward = np.zeros((n, width, k))
        forward[:, 0] = theta[2] + emit[:, 0]
        for j in range(1, width):
            forward[:, j] = np.where(mask[:, j, None], _log_sum(forward[:, j - 1, :, None] + theta[1]) + emit[:, j], forward[:, j - 1])
        norm = _log_sum(forward[:, -1, :, None])[:, 0]
        backward = np.zeros((n, width, k))
        pairs = np.zeros((k, k))
        for j in range(width - 2, -1, -1):
            ahead = emit[:, j + 1] + backward[:, j + 1]
            backward[:, j] = np.where(mask[:, j + 1, None], _log_sum((ahead[:, None, :] + theta[1]).transpose(0, 2, 1)), backward[:, j + 1])
            use = mask[:, j + 1]
            joint = np.exp(forward[use, j, :, None] + theta[1] + ahead[use][:, None, :] - norm[use][:, None, None])
            pairs += joint.sum(axis=0)
        marginal = np.exp(forward + backward - norm[:, None, None]) * mask[:, :, None]
        miss = (one_hot - marginal).reshape(n * width, k)
        g_emit = np.add.reduceat(miss[by_name], name_begins, axis=0)
        g_move = -pairs
        both = mask[:, 1:]
        np.add.at(g_move, (gold[:, :-1][both], gold[:, 1:][both]), 1)
        g_begin = (one_hot[:, 0] - marginal[:, 0]).sum(axis=0)
        for i, g in enumerate((g_emit, g_move, g_begin)):
            g = g / n - decay * (theta[i] - start[i])
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            theta[i] = theta[i] + rate * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8)
    return Crf(names, *theta)


def _log_sum(x):
    """log sum exp over axis 1."""
    top = x.max(axis=1, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=1)) + top[:, 0]


def _labels(text, spans, tokens):
    """Labels of tokens from spans; a token belongs to a span that covers its middle part."""
    out = []
    for a, b in tokens:
        label = 0
        for kind, s, e in spans:
            if a < e and s < b and min(b, e) - max(a, s) >= 0.5 * (b - a):
                label = LABELS.index(f"{'B' if s >= a or (text[s:a].strip(' ') == '') else 'I'}-{kind}")
                break
        out.append(label)
    return out


def _variants(kind, value, pick_one):
    """The same value in forms that the patterns do not know."""
    digits = re.sub("[^0-9]", "", value)
    if kind == "phone" and len(digits) >= 10:
        country, area, mid, end = digits[:-10], digits[-10:-7], digits[-7:-4], digits[-4:]
        return pick_one([f"({area}) {mid}-{end}", f"{area}-{mid}-{end}", f"{area}.{mid}.{end}", f"{country or 1}-{area}-{mid}-{end}", f"00{country or 1} {area} {mid} {end}"])
    if kind == "card":
        mark = pick_one("./")
        return mark.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if kind == "email":
        local, _, host = value.partition("@")
        return pick_one([f"{local}[@]{host}", f"{local}(@){host}", f"{local}@{host.split('.')[0]}", f"{local}@[{host}]", f"{local} at {host.replace('.', ' dot ')}", f"{local} [at] {host.replace('.', ' [dot] ')}"])
    return pick_one([value.replace(".", "[.]"), value.replace(".", "-")]) if kind == "ip" else value


def _plain(token):
    return not marked(token[0])


def _window(text, spans):
    """``(tokens, labels)`` of the stretches of a piece of text."""
    for found in stretches(text):
        yield [text[i:j] for i, j in found], _labels(text, spans, found)


def labelled_windows(texts, seed=7, clean=3):
    """The labelled table from sample texts: ``[(tokens, labels), ...]``.

    Every match is a window with the ``REACH`` tokens of its line to either side, once as it is and once with all values in it
    written in other forms; of a text's stretches without a match up to ``clean`` are taken.
    """
    draw, out = random.Random(seed), []
    for text in texts:
        spans = sorted(base_spans(text), key=lambda s: (s[1], s[2]))
        # Matches that touch are one window, so that no window cuts through a value.
        joined = []
        for kind, a, b in spans:
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], b)
                joined[-1][2].append((kind, a, b))
            else:
                joined.append([a, b, [(kind, a, b)]])
        for k, (a, b, own) in enumerate(joined):
            low = max(text.rfind("\n", 0, a) + 1, joined[k - 1][1] if k else 0)
            high = min(end if (end := text.find("\n", b)) >= 0 else len(text), joined[k + 1][0] if k + 1 < len(joined) else len(text))
            before, after = list(TOKEN.finditer(text, max(low, a - 400), a)), list(TOKEN.finditer(text, b, min(high, b + 400)))
            # Only plain words: what else is marked nearby may be a value in a form that no pattern knows.
            start = min([a, *(m.start() for m in takewhile(_plain, before[:-REACH - 1:-1]))])
            stop = max([b, *(m.end() for m in takewhile(_plain, after[:REACH]))])
            piece = text[start:stop]
            out += _window(piece, [(kind, x - start, y - start) for kind, x, y in own])
            changed, moved, at = "", [], start
            for kind, x, y in own:
                if x < at:
                    continue
                other = _variants(kind, text[x:y], draw.choice)
                changed += text[at:x]
                moved.append((kind, len(changed), len(changed) + len(other)))
                changed, at = changed + other, y
            out += _window(changed + text[at:stop], moved)
        others = [found for found in stretches(text) if not any(x < found[-1][1] and found[0][0] < y for _, x, y in spans)]
        out += [([text[i:j] for i, j in found], [0] * len(found)) for found in draw.sample(others, min(clean, len(others)))]
    return out


#: Numbers that are nobody's data, so that a corpus without them still teaches them.
_ORDINARY = ("2.0", "3.11.4", "19", "1,250", "12:30", "2024-05-17", "17.05.2024", "$49.99", "85%", "v1.2", "100", "1999", "No.7", "4x4", "#12", "7th", "0.005",
             "1/2", "10-12", "ISO-9001", "1234567", "3,000,000", "978-3-16-148410-0", "@handle", "24/7", "00:15:27", "5km", "3785592391142", "x86", "192.168", "1.2.3.4.5")


def ordinary_windows():
    return [([t], [0]) for t in _ORDINARY] + [([t, u], [0, 0]) for t in _ORDINARY[:10] for u in _ORDINARY[3:8]]


def train(df, sample=2000, id_col="doc_id", text_col="text"):
    """A field from at most ``sample`` distinct texts: as many for each kind that have a match of it, and for none.

    Matches are looked for in all documents, so a kind that the table holds anywhere is labelled however rare it is;
    within a kind texts are taken by their hash, and so are windows, of which there are as many as texts at most. The
    bounds keep what reaches the driver small whatever the table holds. A kind without any match is not learned; None
    when there is no match at all.
    """
    docs = pick(df, id_col, text_col).where("text IS NOT NULL").select("text", F.xxhash64("text").alias("h"))
    each = max(1, sample // (len(KINDS) + 1))
    # A task answers with the first hashes of each kind; the texts of the chosen are cut to windows on the executors.
    first = stage(docs.where(F.col("text").rlike("[0-9@]")).mapInArrow(per_task(_first_hashes(each)), "kind int, h long").distinct(), "hashes")
    chosen = sorted({r.h for kind in range(len(KINDS) + 1) for r in first.where(F.col("kind") == kind).orderBy("h").limit(each).collect()})
    if first.where("kind > 0").isEmpty():
        return None
    # At most as many as the sample: a broadcast, not a list in the plan.
    wanted = df.sparkSession.createDataFrame([(h,) for h in chosen], "h long")
    windows = docs.join(F.broadcast(wanted), "h", "left_semi").select("text").distinct().mapInPandas(_window_rows, "tokens array<string>, labels array<int>")
    windows = stage(windows.withColumn("wid", F.monotonically_increasing_id()), "windows")
    order, rows = (F.xxhash64("tokens"), F.to_json("tokens"), F.to_json("labels")), {}
    for kind in range(len(KINDS) + 1):
        begins = LABELS.index(f"B-{KINDS[kind - 1]}") if kind else 0
        own = F.array_contains("labels", begins) | F.array_contains("labels", begins + 1) if kind else F.array_max("labels") == 0
        for r in windows.where(own).orderBy(*order).limit(each).collect():
            rows[r.wid] = (list(r.tokens), list(r.labels))
    return fit(sorted(rows.values()) + ordinary_windows()) if rows else None


def _first_hashes(each):
    """Per task and kind (0: no match) the ``each`` least hashes of texts, each once."""
    def run(batches):
        held = [np.zeros(0, np.int64) for _ in range(len(KINDS) + 1)]
        for batch in chunks(batches):
            found = [[] for _ in held]
            for text, h in zip(texts_of(batch), batch.column(batch.schema.get_field_index("h")).to_pylist()):
                for kind in {KINDS.index(s[0]) + 1 for s in base_spans(text)} or {0}:
                    found[kind].append(h)
            held = [np.unique(np.concatenate([a, np.array(b, np.int64)]))[:each] for a, b in zip(held, found)]
        for kind, h in enumerate(held):
            yield pa.RecordBatch.from_pydict({"kind": pa.array([kind] * len(h), pa.int32()), "h": pa.array(h)})
    return run


def _window_rows(frames):
    import pandas as pd
    for frame in frames:
        # A seed of its own for every text: the same windows however rows are dealt to batches.
        rows = [row for text in frame["text"] for row in labelled_windows([text], seed=zlib.crc32(text.encode()))]
        yield pd.DataFrame({"tokens": [t for t, _ in rows], "labels": [y for _, y in rows]})


_TRIM = re.compile(r"^[\"'<\[{#$%&*,;:!?]+|[\"'>\]}#$%&*.,;:!?]+$")


def crf_spans(texts, model):
    """For each text the spans that the field finds."""
    where, sequences = [], []
    for i, text in enumerate(texts):
        if marked(text):
            for tokens in stretches(text):
                where.append((i, tokens))
                sequences.append([text[a:b] for a, b in tokens])
    out = [[] for _ in texts]
    for (i, tokens), labels in zip(where, model.viterbi(sequences)):
        text, j = texts[i], 0
        while j < len(tokens):
            name = LABELS[labels[j]]
            k = j + 1
            if name != "O":
                while k < len(tokens) and LABELS[labels[k]] == f"I-{name[2:]}":
                    k += 1
                a, b = tokens[j][0], tokens[k - 1][1]
                core = _TRIM.sub("", text[a:b])
                if core:
                    a += text[a:b].index(core)
                    out[i].append((name[2:], a, a + len(core)))
            j = k
    return out


def plausible(kind, value):
    """Whether a value that the field has found is what its kind says, however it is written."""
    digits = re.sub("[^0-9]", "", value)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "ip":
        parts = re.findall("[0-9]+", value)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return "@" in value.strip("@") or bool(re.search(r"[\[({ ](?:at|AT|At)[\])} ]", value) and SPELLED.search(value))


def find(texts, model=None):
    """For each text ``(base, all spans)``; spans of the field that touch a base span, or are not plausible, are left out."""
    base = [base_spans(t) for t in texts]
    added = crf_spans(texts, model) if model else [[]] * len(texts)
    for text, own, more in zip(texts, base, added):
        fresh = [s for s in more if plausible(s[0], text[s[1]:s[2]]) and not any(s[1] < e and b < s[2] for _, b, e in own)]
        yield own, sorted([*own, *fresh], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def scan(df, model=None, id_col="doc_id", text_col="text"):
    """Spans of personal data in whole texts; one row per row.

    ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (base spans), ``base_sha256``, ``spans`` (all spans,
    ``kind:start:end`` by kind and start) and ``n_added``. Null and empty texts have no spans; repeated rows are
    scanned each; other columns are not read. No shuffle; memory is bounded by a chunk of texts.
    """
    def work(batch):
        out = {name: [] for name in (*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added")}
        for own, every in find(texts_of(batch), model):
            for k in KINDS:
                out[f"n_{k}"].append(sum(s[0] == k for s in own))
            out["base_sha256"].append(hashlib.sha256(written(own).encode()).hexdigest())
            out["spans"].append(written(every))
            out["n_added"].append(len(every) - len(own))
        return out

    return map_texts(pick(df, id_col, text_col), work, [
        *(pa.field(f"n_{k}", pa.int64()) for k in KINDS), pa.field("base_sha256", pa.string()),
        pa.field("spans", pa.string()), pa.field("n_added", pa.int64())])


def mask(text, spans):
    """The text with each stretch of overlapping spans replaced by the kind of its first span."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(df, model=None, text_col="text", chars_col=None):
    """All columns of ``df``, the text with personal data replaced by ``<KIND>``; null stays null.

    ``chars_col``, if given, becomes the length of the new text.
    """
    schema = df.schema

    def run(batches):
        for batch in chunks(batches, text=text_col):
            column = batch.column(batch.schema.get_field_index(text_col))
            texts = ["" if t is None else t for t in column.to_pylist()]
            new = [mask(t, spans) if spans else t for t, (_, spans) in zip(texts, find(texts, model))]
            arrays = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            arrays[text_col] = pa.array([None if old is None else t for old, t in zip(column.to_pylist(), new)], batch.schema.field(text_col).type)
            if chars_col:
                arrays[chars_col] = pa.array([None if t is None else len(t) for t in arrays[text_col].to_pylist()], batch.schema.field(chars_col).type)
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    return df.mapInArrow(per_task(run), schema)
