"""Secrets, and who owns them: a candidate that many owners hold is an example, one of a single owner looks live.

Patterns give the base spans; a run of mixed characters with much entropy is a further candidate. Candidate hashes are
aggregated over the whole corpus by distinct repositories and owners, and each finding gets the verdict of its hash.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kerbside.llm.batches import chunks, emit, id_field, per_task, pick, texts_of
from kerbside.session import stage

# The kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs are maximal, so the length can be asked for at once.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
MIXED = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
DIGIT = re.compile(r"[0-9]")

#: What a credential has at least: bits in all, and of the bits a character that its length allows.
LEAST_BITS, LEAST_DENSITY = 40, 0.78


def base_spans(text):
    """``[(kind, start, end, secret)]`` by start, then kind; leftmost, not overlapping within a kind."""
    out = []
    lower = text.lower()
    if any(n in lower for n in NAMES):
        out += [(m.start(), 0, m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return [(KINDS[k], a, b, s) for a, k, b, s in sorted(out)]


def entropy(secret):
    """Bits per character."""
    _, counts = np.unique(np.frombuffer(secret.encode("utf-32-le"), "<u4"), return_counts=True)
    share = counts / len(secret)
    return float(-(share * np.log2(share)).sum())


def mixed_spans(text, base, least=3.6):
    """Further candidates: runs of letters and digits in both cases with at least ``least`` bits a character."""
    if not DIGIT.search(text):
        return []
    out = []
    for m in MIXED.finditer(text):
        s = m[0]
        if any(c.isdigit() for c in s) and any(c.islower() for c in s) and any(c.isupper() for c in s) and entropy(s) >= least \
                and not any(m.start() < b and a < m.end() for _, a, b, _ in base):
            out.append(("mixed", m.start(), m.end(), s))
    return out


def looks_real(secret):
    """As varied as a credential: neither short and plain nor a few characters over and over."""
    bits = entropy(secret)
    return bits * len(secret) >= LEAST_BITS and bits >= LEAST_DENSITY * min(4.0, np.log2(len(secret)))


def written(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in spans)


FINDING = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.string()), ("real", pa.bool_())])


def findings(df, id_col="doc_id", text_col="text", owner_col="source", repository_col="doc_id"):
    """Base figures and all candidates of each row; the secrets themselves leave the task only as hashes."""
    docs = pick(df, id_col, text_col, owner=owner_col, repository=repository_col) \
        .withColumns({"owner": F.col("owner").cast("string"), "repository": F.col("repository").cast("string")})
    from pyspark.sql.pandas.types import from_arrow_schema
    schema = pa.schema([id_field(docs), ("owner", pa.string()), ("repository", pa.string()), *((f"n_{k}", pa.int64()) for k in KINDS),
                        ("base_sha256", pa.string()), ("found", pa.list_(FINDING))])

    def run(batches):
        for batch in chunks(batches):
            out = {name: [] for name in (*(f"n_{k}" for k in KINDS), "base_sha256", "found")}
            for text in texts_of(batch):
                base = base_spans(text)
                for k in KINDS:
                    out[f"n_{k}"].append(sum(s[0] == k for s in base))
                out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                out["found"].append([
                    {"kind": k, "start": a, "end": b, "hash": hashlib.sha256(s.encode()).hexdigest(), "real": looks_real(s)}
                    for k, a, b, s in (*base, *mixed_spans(text, base))])
            kept = {n: batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "owner", "repository")}
            kept["doc_id"] = kept["doc_id"].cast(schema.field("doc_id").type)
            kept |= {n: kept[n].cast(pa.string()) for n in ("owner", "repository")}
            yield emit(schema, **kept, **out)

    return docs.mapInArrow(per_task(run), from_arrow_schema(schema))


def ownership(candidates, copied_owners=3):
    """For each candidate hash its distinct owners and repositories, and a verdict.

    Owners count by how evenly its repositories are spread over them: with ``r`` repositories of each, it has
    ``sum(r)^2 / sum(r^2)`` owners in effect. A credential of one owner that a fork or two has taken along still has
    little more than one; an example that everybody pastes has as many as hold it. ``copied``: at least
    ``copied_owners`` in effect; ``live``: fewer, and it is as varied as a credential; else ``weak``. Equal (hash, owner, repository) rows fold first, spread over all three, and owners next, so no task ever holds
    the rows of a candidate that a third of all rows have. Null owners and repositories count as none.
    """
    real = F.max("real").alias("real")
    triples = candidates.groupBy("hash", "owner", "repository").agg(real)
    pairs = triples.groupBy("hash", "owner").agg(F.count("repository").alias("repositories"), real)
    known = F.when(F.col("owner").isNotNull(), F.col("repositories").cast("decimal(19,0)"))
    folded = pairs.groupBy("hash").agg(
        F.count("owner").alias("owners"), F.sum("repositories").alias("repositories"), real,
        F.sum(known).alias("held"), F.sum(known * known).alias("squares"))
    # Whole numbers, so that an even spread over just so many owners counts.
    spread = (F.col("held").cast("double") * F.col("held").cast("double") >= F.lit(float(copied_owners)) * F.col("squares").cast("double")) & (F.col("held") > 0)
    verdict = F.when(spread, "copied").when(F.col("real"), "live").otherwise("weak")
    return folded.select("hash", "owners", "repositories", verdict.alias("verdict"))


def scan(df, copied_owners=3, id_col="doc_id", text_col="text", owner_col="source", repository_col="doc_id"):
    """Secrets of whole texts with ownership verdicts; one row per row.

    ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans`` (base spans and the further
    candidates that look live, ``kind:start:end`` by start), ``n_live``, ``n_copied``, ``n_weak``. Null and empty texts
    have no spans; repeated rows are scanned each, a repository counts once; other columns are not read. Only
    rows with candidates are shuffled, and never their texts.
    """
    found = stage(findings(df, id_col, text_col, owner_col, repository_col).withColumn("row", F.monotonically_increasing_id()), "secrets")
    figures = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256"]
    none = found.where(F.size("found") == 0).select(*figures, F.lit("").alias("spans"), *(F.lit(0).cast("long").alias(n) for n in ("n_live", "n_copied", "n_weak")))
    each = found.where(F.size("found") > 0).withColumn("f", F.explode("found")).select("row", *figures, "owner", "repository", "f.*")
    judged = each.join(ownership(each, copied_owners), "hash")
    order = F.when(F.col("kind") == "assign", 0).when(F.col("kind") == "access", 1).when(F.col("kind") == "hex", 2).otherwise(3)
    shown = F.when((F.col("kind") != "mixed") | (F.col("verdict") == "live"), F.struct("start", order.alias("at"), F.concat_ws(":", "kind", "start", "end").alias("span")))
    some = judged.groupBy("row").agg(
        *(F.first(c).alias(c) for c in figures), F.array_sort(F.collect_list(shown)).alias("shown"),
        *(F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("live", "copied", "weak")))
    return none.unionByName(some.select(*figures, F.array_join(F.col("shown.span"), ",").alias("spans"), "n_live", "n_copied", "n_weak"))
