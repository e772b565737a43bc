"""Fixed word lists and character maps used by the text functions.

Everything here is plain data. The accent map is generated by a rule
(Unicode compatibility decomposition with combining marks dropped) so
it never has to be typed out; the handful of letters that do not
decompose are listed as fixed values below.
"""

from __future__ import annotations

import string
import unicodedata

# --- fixed values -----------------------------------------------------------
# ASCII punctuation deleted by the text normaliser (same set as Python's
# ``string.punctuation``).
PUNCTUATION = string.punctuation  # !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~

# Latin letters with no Unicode decomposition and their ASCII spelling.
EXTRA_FOLDS = {
    "ß": "ss", "ẞ": "SS",
    "æ": "ae", "Æ": "AE",
    "œ": "oe", "Œ": "OE",
    "ø": "o", "Ø": "O",
    "đ": "d", "Đ": "D",
    "ð": "d", "Ð": "D",
    "ł": "l", "Ł": "L",
    "þ": "th", "Þ": "Th",
    "ı": "i", "ħ": "h", "Ħ": "H",
    "ŧ": "t", "Ŧ": "T",
    "ŋ": "ng", "Ŋ": "NG",
}

# General Punctuation with an ASCII spelling.
PUNCTUATION_FOLDS = {
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2014": "--", "\u2015": "--",
    "\u2018": "'", "\u2019": "'", "\u201a": ",", "\u201b": "'",
    "\u201c": '"', "\u201d": '"', "\u201e": ",,", "\u201f": '"',
    "\u2022": "*", "\u2026": "...", "\u2032": "'", "\u2033": "''", "\u2039": "<", "\u203a": ">",
    "\u00a0": " ", "\u2002": " ", "\u2003": " ", "\u2009": " ", "\u202f": " ", "\u00ab": "<<", "\u00bb": ">>",
}

# Stop words removed after accent folding. Entries that carry accents can
# never match folded tokens; they are kept on purpose (faithful behaviour),
# pass ``fold_list=True`` to fold the list as well.
STOP_WORDS = (
    # Portuguese
    "a", "ao", "aos", "as", "com", "como", "da", "das", "de", "do", "dos",
    "e", "é", "ela", "ele", "em", "entre", "era", "essa", "esse", "esta",
    "este", "eu", "foi", "há", "isso", "já", "lhe", "mais", "mas", "me",
    "muito", "na", "nas", "não", "no", "nos", "o", "os", "ou", "para",
    "pela", "pelo", "por", "que", "se", "sem", "seu", "sua", "também",
    "um", "uma", "você",
    # English
    "about", "after", "all", "an", "and", "are", "at", "be", "been", "but",
    "by", "can", "for", "from", "had", "has", "have", "he", "her", "his",
    "i", "if", "in", "into", "is", "it", "its", "not", "of", "on", "or",
    "she", "so", "than", "that", "the", "their", "them", "then", "there",
    "these", "they", "this", "to", "was", "we", "were", "what", "when",
    "which", "who", "will", "with", "would", "you",
)

# Lemma lexicon: inflected form -> lemma. Tokens not listed keep their form.
LEMMAS = (
    ("am", "be"), ("are", "be"), ("is", "be"), ("was", "be"), ("were", "be"),
    ("been", "be"), ("being", "be"),
    ("has", "have"), ("had", "have"), ("having", "have"),
    ("does", "do"), ("did", "do"), ("done", "do"), ("doing", "do"),
    ("went", "go"), ("gone", "go"), ("goes", "go"),
    ("said", "say"), ("says", "say"),
    ("made", "make"), ("makes", "make"),
    ("sou", "ser"), ("somos", "ser"), ("sao", "ser"), ("foi", "ser"),
    ("foram", "ser"), ("era", "ser"),
    ("estou", "estar"), ("esta", "estar"), ("estao", "estar"),
    ("tenho", "ter"), ("tem", "ter"), ("tinha", "ter"),
    ("fez", "fazer"), ("faz", "fazer"),
)

# Regular inflections, form and lemma in turn, from which edit scripts are counted (T8b). Words that
# only look inflected are their own lemma.
REGULAR_LEMMAS = """
cats cat dogs dog titles title roles role books book cars car words word things thing days day years year hands hand trees tree
studies study cities city stories story parties party families family countries country
boxes box wishes wish classes class churches church watches watch
walked walk talked talk worked work asked ask played play wanted want looked look
used use loved love moved move closed close tried try carried carry studied study
stopped stop planned plan walking walk talking talk working work playing play looking look
class class glass glass press press grass grass status status virus virus bonus bonus
king king ring ring spring spring thing thing seed seed need need red red bed bed
gatos gato livros livro carros carro meninos menino casas casa meninas menina palavras palavra coisas coisa
cidades cidade paredes parede nomes nome flores flor cores cor senhores senhor valores valor
animais animal jornais jornal hospitais hospital papeis papel hoteis hotel
acoes acao nacoes nacao licoes licao razoes razao homens homem imagens imagem viagens viagem
falando falar andando andar cantando cantar comendo comer vivendo viver falava falar andava andar cantava cantar
falou falar andou andar cantou cantar falado falar andado andar cantado cantar
""".split()

# Special token ids of the whole-word encoder.
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 1, 2, 3
FIRST_WORD_ID = 4
# --- end of fixed values ----------------------------------------------------


def _decomposed_folds() -> dict[str, str]:
    """Latin letters (Latin-1 to Extended-B, and Extended Additional) that decompose to ASCII."""
    out: dict[str, str] = {}
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        ch = chr(cp)
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if base != ch and base.isascii() and base:
            out[ch] = base
    return out


def accent_folds() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Return ``(from_chars, to_chars, multi)`` for ``translate`` + ``replace``.

    One-to-one folds go into a single ``translate``; folds that expand to
    two letters (``ß`` -> ``ss``) are applied with ``replace`` afterwards.
    """
    folds = _decomposed_folds()
    folds.update(EXTRA_FOLDS)
    folds.update(PUNCTUATION_FOLDS)
    single = sorted((k, v) for k, v in folds.items() if len(v) == 1)
    multi = tuple(sorted((k, v) for k, v in folds.items() if len(v) > 1))
    return "".join(k for k, _ in single), "".join(v for _, v in single), multi


def fold_word(word: str) -> str:
    """Python twin of the column-level accent fold (for folding word lists)."""
    src, dst, multi = accent_folds()
    out = word.translate(str.maketrans(src, dst))
    for k, v in multi:
        out = out.replace(k, v)
    return "".join(c for c in out if c.isascii())
