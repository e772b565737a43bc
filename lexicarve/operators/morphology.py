"""Stems (T8a) and lemmas of words outside the lexicon.

Both work on the table of distinct words, once per word, and are joined
back to the tokens (J4), so their cost follows the vocabulary and not the
corpus. Regions, suffixes and edit scripts are Column expressions.

Defined cases: a null word has a null stem and no lemma; empty words and
symbols are their own stems; repeated words give one row in ``lemma_table``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: vowels and suffixes of the published Portuguese stemming rules --------------------
VOWELS = "aeiouáéíóúâêô"
REMOVED = """eza ezas ico ica icos icas ismo ismos ável ível ista istas oso osa osos osas amento amentos imento imentos
adora ador aça~o adoras adores aço~es ante antes ância""".split()
REPLACED = {"log": ("logia", "logias"), "u": ("uça~o", "uço~es"), "ente": ("ência", "ências")}
# ending: what may go before it as well, longest first
FOLLOWED = {"mente": ("ante", "avel", "ível"), "idade": ("abil", "ic", "iv"), "idades": ("abil", "ic", "iv"),
            "iva": ("at",), "ivo": ("at",), "ivas": ("at",), "ivos": ("at",)}
BEFORE_AMENTE = ("ativ", "iv", "os", "ic", "ad")
VERBAL = """ada ida ia aria eria iria ará ara erá era irá ava asse esse isse aste este iste ei arei erei irei am iam ariam eriam
iriam aram eram iram avam em arem erem irem assem essem issem ado ido ando endo indo ara~o era~o ira~o ar er ir as adas idas ias
arias erias irias arás aras erás eras irás avas es ardes erdes irdes ares eres ires asses esses isses astes estes istes is ais eis
íeis aríeis eríeis iríeis áreis areis éreis ereis íreis ireis ásseis ésseis ísseis áveis ados idos ámos amos íamos aríamos eríamos
iríamos áramos éramos íramos ávamos emos aremos eremos iremos ássemos êssemos íssemos imos armos ermos irmos eu iu ou ira
iras""".split()
RESIDUAL = ("os", "a", "i", "o", "á", "í", "ó")
# --- end of fixed values -----------------------------------------------------------------------------

_V, _C = f"[{VOWELS}]", f"[^{VOWELS}]"
_R1 = f"^{_C}*{_V}+{_C}"
_R2 = f"{_R1}{_C}*{_V}+{_C}"
_RV = f"^(?:.{_C}+{_V}|{_V}{_V}+{_C}|{_C}{_V}.)"


def _ending(word: Column, endings) -> Column:
    """The longest of the endings that the word has, or ''."""
    return F.regexp_extract(word, f"(?:{'|'.join(endings)})$", 0)


def _less(word: Column, n) -> Column:
    """The word without its last n characters."""
    return F.left(word, F.length(word) - n)


def _start(word: Column, pattern: str) -> Column:
    """Characters before a region; the whole word where it has none."""
    before = F.length(F.regexp_extract(word, pattern, 0))
    return F.when(before > 0, before).otherwise(F.length(word))


def _also(word: Column, r2: Column, endings) -> Column:
    """The word without the first of the endings that it has inside R2."""
    out = None
    for e in endings:
        test, cut = word.endswith(e) & (F.length(word) - len(e) >= r2), _less(word, len(e))
        out = F.when(test, cut) if out is None else out.when(test, cut)
    return out.otherwise(word)


def stems(words: DataFrame, word: str = "token") -> DataFrame:
    """(word, stem) of every row by the published suffix rules for Portuguese; words are lower-cased first."""
    w, r1, r2, rv, s, b = (F.col(c) for c in ("w", "r1", "r2", "rv", "s", "b"))
    d = words.select(F.col(word).alias("word"), F.replace(F.replace(F.lower(word), F.lit("ã"), F.lit("a~")), F.lit("õ"), F.lit("o~")).alias("w"))
    d = d.select("word", "w", _start(w, _R1).alias("r1"), _start(w, _R2).alias("r2"), _start(w, _RV).alias("rv"))

    # nominal endings: only the longest one is tried
    known = [*REMOVED, *(e for group in REPLACED.values() for e in group), "amente", *FOLLOWED, "ira", "iras"]
    d = d.withColumn("s", _ending(w, known)).withColumn("b", _less(w, F.length(s)))
    in_r2 = F.length(b) >= r2
    nominal = F.when(s.isin(REMOVED) & in_r2, b)
    for new, group in REPLACED.items():
        nominal = nominal.when(s.isin(*group) & in_r2, F.concat(b, F.lit(new)))
    nominal = nominal.when((s == "amente") & (F.length(b) >= r1), _also(b, r2, BEFORE_AMENTE))
    for end, before in FOLLOWED.items():
        nominal = nominal.when((s == end) & in_r2, _also(b, r2, before))
    nominal = nominal.when(s.isin("ira", "iras") & (F.length(b) >= rv) & b.endswith("e"), F.concat(b, F.lit("ir")))

    # verbal endings inside RV where no nominal one went, then a final i after c; else a residual vowel
    d = d.withColumn("x", nominal).withColumn("v", _ending(F.substring(w, rv + 1, F.length(w)), VERBAL))
    d = d.withColumn("x", F.coalesce("x", F.when(F.col("v") != "", _less(w, F.length("v")))))
    x, t = F.col("x"), _ending(w, RESIDUAL)
    after = F.when(x.endswith("ci") & (F.length(x) > rv), _less(x, 1)).otherwise(x)
    d = d.withColumn("x", F.coalesce(after, F.when((t != "") & (F.length(w) - F.length(t) >= rv), _less(w, F.length(t))), w))

    # a final e inside RV, with the u of gu or the i of ci; a cedilla
    e = x.rlike("[eéê]$") & (F.length(x) > rv)
    gone = F.when(x.rlike("(gu|ci).$") & (F.length(x) - 2 >= rv), _less(x, 2)).otherwise(_less(x, 1))
    stem = F.when(e, gone).when(x.endswith("ç"), F.concat(_less(x, 1), F.lit("c"))).otherwise(x)
    return d.select(F.col("word").alias(word), F.replace(F.replace(stem, F.lit("a~"), F.lit("ã")), F.lit("o~"), F.lit("õ")).alias("stem"))


def lemma_rules(lexicon: DataFrame, longest: int = 6, support: int = 2) -> DataFrame:
    """(suffix, cut, add): the edit script of most pairs of the lexicon (token, lemma) whose token ends so.

    A script takes ``cut`` characters off and puts ``add`` there; it is
    counted for every suffix of at most ``longest`` characters that holds
    the cut. Scripts of fewer than ``support`` pairs are no rule. Ties go
    to the shorter cut, then to the greater ``add``.
    """
    t, m = F.col("token"), F.col("lemma")
    both = F.least(F.length(t), F.length(m))
    same = F.size(F.filter(F.sequence(F.lit(1), both), lambda i: F.left(t, i) == F.left(m, i)))
    d = lexicon.where((t != "") & (m != "")).select("token", "lemma").distinct()
    d = d.select("token", (F.length(t) - same).alias("cut"), F.substring(m, same + 1, F.length(m)).alias("add"))
    sizes = F.filter(F.sequence(F.lit(1), F.lit(longest)), lambda k: (k >= F.col("cut")) & (k <= F.length(t)))
    d = d.select("token", "cut", "add", F.explode(sizes).alias("k")).select(F.right("token", F.col("k")).alias("suffix"), "cut", "add")
    n = d.groupBy("suffix", "cut", "add").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support)
    return n.groupBy("suffix").agg(F.max_by(F.struct("cut", "add"), F.struct("n", -F.col("cut"), "add")).alias("r")).select("suffix", "r.*")


def lemma_table(words: DataFrame, lexicon: DataFrame, rules: DataFrame, word: str = "token", longest: int = 6, least: int = 3) -> DataFrame:
    """(token, lemma) of every distinct word that the lexicon or a rule knows.

    The lexicon goes first; else the rule of the longest suffix that leaves
    ``least`` characters or more. Symbols and numbers match no rule.
    """
    t = F.col("token")
    known = lexicon.where("token <> ''").groupBy("token").agg(F.min("lemma").alias("lemma"))
    new = words.select(F.col(word).alias("token")).where("token is not null").distinct().join(known, "token", "left_anti")
    sizes = F.filter(F.sequence(F.lit(1), F.lit(longest)), lambda k: k <= F.length(t))
    tails = new.select("token", F.explode(sizes).alias("k")).withColumn("suffix", F.right(t, F.col("k")))
    hit = tails.join(rules, "suffix").where(F.length(t) - F.col("cut") >= least)
    best = hit.groupBy("token").agg(F.max_by(F.struct("cut", "add"), "k").alias("r"))
    lemma = F.concat(_less(t, F.col("r.cut")), F.col("r.add"))
    return known.unionByName(best.select("token", lemma.alias("lemma")))


def replace_tokens(long: DataFrame, table: DataFrame, new: str) -> DataFrame:
    """Every token of (key, pos, token) by the table (token, ``new``); tokens that it lacks stay."""
    return long.join(table, "token", "left").withColumn("token", F.coalesce(F.col(new), "token")).drop(new)
