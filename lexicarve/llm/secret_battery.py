r"""Secret scan: fixed patterns, and a randomness test battery with false-discovery control.

Fixed patterns (leftmost, non-overlapping per kind, then dropped if too
short): ``assign``, ``access`` and ``hex``. The battery adds ``random``
spans. Candidates are maximal runs of at least 16 encoding characters. The
smallest alphabet that holds a run is its inferred encoding; runs of
letters that look like words (one case, or a capital first) have none. A
run that mixes signs of two alphabets, as a key in a path does, is split
at its signs and its parts of at least 16 characters are candidates.
Three tests against uniform draws from that alphabet give p-values that
Fisher's method combines: chi-squared uniformity, runs about the middle of
the alphabet, and lag-1 serial correlation. Random strings have large
values, ordinary text small ones, the more so the longer it is.

False discoveries are controlled by length: for every candidate a decoy of
the same length and alphabet is cut from the ordinary text around it and
put to the same tests. Counts of candidates and decoys by (family of
encoding, length band, bin of the p-value) are summed over the whole
corpus; the cut of a stratum is the least strict one at which decoys that
pass are at most ``FDR`` of the candidates that pass. A stratum of fewer
than ``ENOUGH`` candidates takes the cut of its family, a family of fewer
that of all, and where all are fewer, ``FALLBACK`` is the cut.

Spans are code points, end exclusive. Defined cases: a null or empty text
has no spans; a stratum (or what it is pooled into) without an acceptable
cut adds none; of spans with one start the fixed patterns come first, and
random spans may overlap them; repeated rows
are returned as often as they occur and count as often.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, shared

KINDS = ["assign", "access", "hex", "random"]  # in the order that breaks ties of start
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_HINTS = ("passw", "secret", "token", "api_key", "apikey")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # 18 characters or more
_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
ASSIGN_MIN = 12
_SIGN = re.compile(r"[+/_-]")
_PROSE = re.compile(r"[A-Za-z0-9]+")
AROUND = 400  # code points of context on either side that a decoy is cut from
FDR = 0.05
ENOUGH = 100
FALLBACK = 2  # bins up to this one: p-values above 0.17
BINS = 40  # of a quarter of a decade of the p-value each
BANDS = [16, 20, 24, 32, 48, 64]

_LOW, _UP, _DIG = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# (name, family, alphabet) by size
ENCODINGS = [
    ("decimal", "digits", _DIG), ("hex", "mixed", _DIG + "abcdef"), ("HEX", "mixed", _DIG + "ABCDEF"),
    ("base32", "mixed", _UP + "234567"), ("alnum_lower", "mixed", _DIG + _LOW), ("alnum_upper", "mixed", _DIG + _UP),
    ("letters", "letters", _UP + _LOW), ("base62", "mixed", _DIG + _UP + _LOW),
    ("base64", "mixed", _UP + _LOW + _DIG + "+/"), ("base64url", "mixed", _UP + _LOW + _DIG + "-_"),
]
_SETS = [(name, family, alphabet, frozenset(alphabet), {c: i for i, c in enumerate(alphabet)}) for name, family, alphabet in ENCODINGS]


def infer(run: str):
    """The smallest encoding that holds ``run``, or None for words and mixtures."""
    rest = run[1:]
    if run.isalpha() and (run.islower() or run.isupper() or rest.islower()):
        return None
    chars = set(run)
    return next((e for e in _SETS if chars <= e[3]), None)


def _tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(run: str, place: dict[str, int]) -> float:
    """Combined p-value of the three tests for uniform draws from the alphabet ``place``."""
    n, a = len(run), len(place)
    x = [place[c] for c in run]
    seen = [0] * a
    for i in x:
        seen[i] += 1
    df = a - 1
    chi = sum(c * c for c in seen) * a / n - n
    k = 2 / (9 * df)  # Wilson-Hilferty
    p_chi = _tail(((max(chi, 0.0) / df) ** (1 / 3) - (1 - k)) / math.sqrt(k))
    up = [2 * i >= a for i in x]
    runs = 1 + sum(u != v for u, v in zip(up, up[1:]))
    p_runs = 2 * _tail(abs(runs - (n + 1) / 2) / math.sqrt((n - 1) / 4))
    mean, var = (a - 1) / 2, (a * a - 1) / 12
    serial = sum((u - mean) * (v - mean) for u, v in zip(x, x[1:])) / (var * (n - 1))
    p_serial = 2 * _tail(abs(serial) * math.sqrt(n - 1))
    half = -sum(math.log(max(p, 1e-300)) for p in (p_chi, p_runs, p_serial))
    return math.exp(-half) * (1 + half + half * half / 2)  # chi-squared with 6 degrees of freedom


def stratum(family: str, n: int) -> str:
    return f"{family}-{max(b for b in BANDS if b <= n)}"


def level(p: float) -> int:
    """Bin of a p-value; 0 holds the largest."""
    return min(BINS - 1, int(-4 * math.log10(max(p, 1e-300))))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    out = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _inferred(text: str):
    """(start, run, encoding) of the runs that have an encoding, split where a whole run mixes two alphabets."""
    for m in _RUN.finditer(text):
        e = infer(m[0])
        if e:
            yield m.start(), m[0], e
        elif _SIGN.search(m[0]):
            at = m.start()
            for part in _SIGN.split(m[0]):
                e = infer(part) if len(part) >= BANDS[0] else None
                if e:
                    yield at, part, e
                at += len(part) + 1


def candidates(text: str):
    """Candidate runs as (start, end, stratum, bin) and their decoys as (stratum, bin)."""
    found, decoys = [], []
    for start, run, e in _inferred(text):
        n, s = len(run), stratum(e[1], len(run))
        found.append((start, start + n, s, level(battery(run, e[4]))))
        around = text[max(0, start - AROUND):start] + " " + text[start + n:start + n + AROUND]
        prose = "".join(c for w in _PROSE.findall(around) if len(w) < BANDS[0] for c in w if c in e[3])
        if len(prose) >= n:
            decoys.append((s, level(battery(prose[:n], e[4]))))
    return found, decoys


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, found, decoys) per row: spans of the fixed patterns, tested candidates, tested decoys."""
    d = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    schema = (f"k {d.schema['k'].dataType.simpleString()}, base array<struct<start:int,kind:int,end:int>>, "
              "found array<struct<start:int,end:int,stratum:string,bin:int>>, decoys array<struct<stratum:string,bin:int>>")
    i, s = pa.int32(), pa.string()
    kinds = [pa.list_(pa.struct([("start", i), ("kind", i), ("end", i)])),
             pa.list_(pa.struct([("start", i), ("end", i), ("stratum", s), ("bin", i)])),
             pa.list_(pa.struct([("stratum", s), ("bin", i)]))]

    def run(batches):
        for b in batches:
            cols = [[], [], []]
            for t in b.column(1).to_pylist():
                found, decoys = candidates(t) if t else ([], [])
                cols[0].append([dict(zip(("start", "kind", "end"), x)) for x in base_spans(t)] if t else [])
                cols[1].append([dict(zip(("start", "end", "stratum", "bin"), x)) for x in found])
                cols[2].append([dict(zip(("stratum", "bin"), x)) for x in decoys])
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             names=["k", "base", "found", "decoys"])

    return in_arrow(d, run, schema).withColumnRenamed("k", key)


def cuts(scanned: DataFrame, fdr: float = FDR) -> DataFrame:
    """(stratum, cut): candidates in bins up to ``cut`` are reported. One row per stratum at most; pools are left out."""
    return pooled_cuts(scanned, fdr).where(~F.endswith("stratum", F.lit("*")) & F.col("cut").isNotNull()).select("stratum", "cut")


def pooled_cuts(scanned: DataFrame, fdr: float = FDR) -> DataFrame:
    """(stratum, n, cut): candidates and cut (null: none) of every stratum, and of the pools "family-*" and "*"."""
    one = scanned.select(F.explode("found").alias("x")).select("x.stratum", "x.bin", F.lit(1).alias("c"), F.lit(0).alias("d"))
    two = scanned.select(F.explode("decoys").alias("x")).select("x.stratum", "x.bin", F.lit(0).alias("c"), F.lit(1).alias("d"))
    pools = F.array("stratum", F.concat(F.substring_index("stratum", "-", 1), F.lit("-*")), F.lit("*"))
    both = one.unionByName(two).groupBy("stratum", "bin").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    bins = both.select(F.explode(pools).alias("stratum"), "bin", "c", "d").groupBy("stratum", "bin").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    run, whole = Window.partitionBy("stratum").orderBy("bin"), Window.partitionBy("stratum")
    # decoys stand for all candidates of the stratum, also those without text around them
    scale = F.sum("c").over(whole) / F.greatest(F.sum("d").over(whole), F.lit(1))
    rate = (1 + scale * F.sum("d").over(run)) / F.greatest(F.sum("c").over(run), F.lit(1))
    passing = F.when(F.col("rate") <= fdr, F.col("bin"))
    return bins.withColumn("rate", rate).groupBy("stratum").agg(F.sum("c").alias("n"), F.max(passing).alias("cut"))


def chosen_cuts(table: dict[str, tuple[int, int | None]]) -> dict[str, int]:
    """The cut of every stratum from {stratum or pool: (candidates, cut)}; strata without one are left out."""
    out = {}
    for s in (k for k in table if not k.endswith("*")):
        near = [s, f"{s.split('-')[0]}-*", "*"]
        n, cut = next((table[k] for k in near if table[k][0] >= ENOUGH), (0, FALLBACK))
        if cut is not None:
            out[s] = cut
    return out


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", fdr: float = FDR) -> DataFrame:
    """(key, base, spans): arrays of (start, kind number, end), sorted; ``spans`` includes the battery's."""
    scanned = shared(scan(docs, key, text), "secret-scan")
    limit = chosen_cuts({r["stratum"]: (r["n"], r["cut"]) for r in pooled_cuts(scanned, fdr).collect()})  # families x length bands at most
    table = F.create_map(*[F.lit(x) for kv in limit.items() for x in kv]) if limit else F.lit(None).cast("map<string,int>")
    passed = F.filter("found", lambda x: F.coalesce(x["bin"] <= F.try_element_at(table, x["stratum"]), F.lit(False)))
    extra = F.transform(passed, lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("kind"), x["end"].alias("end")))
    return scanned.select(key, "base", F.array_sort(F.concat("base", extra)).alias("spans"))


def spelled(spans):
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
