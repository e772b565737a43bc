"""DuckDB twins of the text functions, for oracle queries.

Nothing here is imported from the functions under test: accents go by
DuckDB's own ``strip_accents``, and lists and patterns are spelled out.
"""

from __future__ import annotations

EMPTY = "''"
# The same lists as the library's, written out once more.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
STOP = """a ao aos as com como da das de do dos e é ela ele em entre era essa esse esta este eu foi há isso já lhe mais mas me
muito na nas não no nos o os ou para pela pelo por que se sem seu sua também um uma você
about after all an and are at be been but by can for from had has have he her his i if in into is it its not of on or she so than
that the their them then there these they this to was we were what when which who will with would you""".split()
LEMMAS = """am be are be is be was be were be been be being be has have had have having have does do did do done do doing do
went go gone go goes go said say says say made make makes make sou ser somos ser sao ser foi ser foram ser era ser
estou estar esta estar estao estar tenho ter tem ter tinha ter fez fazer faz fazer""".split()
SPELLED = [("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("ø", "o"), ("đ", "d"), ("ð", "d"), ("ł", "l"), ("þ", "th"), ("’", "'"), ("‘", "'"),
           ("“", '"'), ("”", '"'), ("–", "-"), ("—", "--"), ("…", "..."), ("\u00a0", " "), ("«", "<<"), ("»", ">>")]


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip_punctuation(x: str) -> str:
    return f"translate({x}, {lit(PUNCTUATION)}, '')"


def fold_accents(x: str) -> str:
    """Lower case is applied outside; letters are folded after it, so only small ones are listed."""
    out = f"lower({x})"
    for k, v in SPELLED:
        out = f"replace({out}, {lit(k)}, {lit(v)})"
    return f"regexp_replace(strip_accents({out}), '[^\\x00-\\x7F]', '', 'g')"


def preprocess(x: str) -> str:
    return f"lower({fold_accents(strip_punctuation(f'coalesce({x}, {EMPTY})'))})"


def normalise(x: str) -> str:
    return f"lower({fold_accents(f'coalesce({x}, {EMPTY})')})"


def tokenize(x: str) -> str:
    return f"regexp_extract_all({x}, {lit(r"[a-z0-9_]+|[^a-z0-9_\s]")}, 0)"


def word_tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {lit(r"[a-z0-9_]+")}, 0)"


def stop_list() -> str:
    return "[" + ", ".join(lit(w) for w in STOP) + "]"


def remove_stop_words(tok: str) -> str:
    return f"list_filter({tok}, lambda t: NOT list_contains({stop_list()}, t))"


def lemma_case(t: str) -> str:
    whens = " ".join(f"WHEN {lit(a)} THEN {lit(b)}" for a, b in zip(LEMMAS[::2], LEMMAS[1::2]))
    return f"CASE {t} {whens} ELSE {t} END"


def lemmatize(tok: str) -> str:
    return f"list_transform({tok}, lambda t: {lemma_case('t')})"


def default_tokenizer(x: str) -> str:
    return lemmatize(remove_stop_words(tokenize(normalise(x))))


def ngrams(tok: str, n: int) -> str:
    return (f"list_transform(range(1, len({tok}) - {n - 1} + 1), "
            f"lambda i: array_to_string({tok}[i:i + {n - 1}], ' '))")


def all_ngrams(tok: str, n_min: int = 1, n_max: int = 4) -> str:
    parts = [ngrams(tok, n) for n in range(n_min, n_max + 1)]
    out = parts[0]
    for p in parts[1:]:
        out = f"list_concat({out}, {p})"
    return out


# --- fixed values: stemming suffixes, regular lemmas and spellings of other scripts, written out once more ---
NOMINAL = """eza ezas ico ica icos icas ismo ismos ável ível ista istas oso osa osos osas amento amentos imento imentos adora ador aça~o
adoras adores aço~es ante antes ância""".split()
VERBAL = """ada ida ia aria eria iria ará ara erá era irá ava asse esse isse aste este iste ei arei erei irei am iam ariam eriam iriam
aram eram iram avam em arem erem irem assem essem issem ado ido ando endo indo ara~o era~o ira~o ar er ir as adas idas ias
arias erias irias arás aras erás eras irás avas es ardes erdes irdes ares eres ires asses esses isses astes estes istes is
ais eis íeis aríeis eríeis iríeis áreis areis éreis ereis íreis ireis ásseis ésseis ísseis áveis ados idos ámos amos íamos
aríamos eríamos iríamos áramos éramos íramos ávamos emos aremos eremos iremos ássemos êssemos íssemos imos armos ermos irmos
eu iu ou ira iras""".split()
REGULAR = """cats cat dogs dog titles title roles role books book cars car words word things thing days day years year hands hand trees tree
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
falou falar andou andar cantou cantar falado falar andado andar cantado cantar""".split()
LATIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
GREEK = "αάβγδεέζηθιίκλμνξοπρσςτυφχΑΆΒΓΔΕΈΖΗΘΙΊΚΛΜΝΞΟΠΡΣΎΤΥΦΧ"
GREEK_SPELLED = """a a b g d e e z e th i i k l m n x o p r s s t u ph kh
A A B G D E E Z E Th I I K L M N X O P R S U T U Ph Kh""".split()
CYRILLIC = "абвгдежзийклмнопрстуфхцчшщЪЫЬЭЮЯЁЄІЇҐАБВГДЕЖЗИЙКЛМНО"
CYRILLIC_SPELLED = """a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch
- Y ' E Iu Ia Io Ie I I G A B V G D E Zh Z I I K L M N O""".split()
HANGUL = "가각갂한글꽃닭밟삶앉없읽훑힣쌀왜웬위의뒤짜차카타파하"
HANGUL_SPELLED = "ga gag gagg han geul ggoc dalg balb salm anj eobs ilg hult hih ssal wae wen wi yi dwi jja ca ka ta pa ha".split()
# --- end of fixed values --------------------------------------------------------------------------------------


def other_scripts(x: str, key: str) -> str:
    """The text as it is, or with its letters in Greek, Cyrillic or Hangul, by the key (Spark and DuckDB)."""
    return (f"CASE {key} % 4 WHEN 1 THEN translate({x}, '{LATIN}', '{GREEK}') WHEN 2 THEN translate({x}, '{LATIN}', '{CYRILLIC}') "
            f"WHEN 3 THEN translate({x}, '{LATIN[:26]}', '{HANGUL}') ELSE {x} END")


def romanize(x: str) -> str:
    out = f"replace({x}, 'ß', 'ss')"
    for k, v in [*zip(GREEK, GREEK_SPELLED), *zip(CYRILLIC, CYRILLIC_SPELLED), *zip(HANGUL, HANGUL_SPELLED)]:
        out = f"replace({out}, '{k}', {lit('' if v == '-' else v)})"
    return f"regexp_replace(strip_accents({out}), '[^\\x00-\\x7F]', '', 'g')"


def values(words: list[str]) -> str:
    return ", ".join(f"({lit(a)}, {lit(b)})" for a, b in zip(words[::2], words[1::2]))


def stems(words: str) -> str:
    """(token, stem) of a table of tokens, as one query."""
    v, c = "[aeiouáéíóúâêô]", "[^aeiouáéíóúâêô]"
    r1 = f"{c}*{v}+{c}"
    ends = "|".join([*NOMINAL, "logia", "logias", "uça~o", "uço~es", "ência", "ências", "amente", "mente", "idade", "idades",
                     "iva", "ivo", "ivas", "ivos", "ira", "iras"])

    def region(pattern, name):
        return f"CASE WHEN regexp_matches(w, '^{pattern}') THEN length(regexp_extract(w, '^{pattern}')) ELSE length(w) END AS {name}"

    return f"""
WITH n0 AS (SELECT DISTINCT token, replace(replace(lower(token), 'ã', 'a~'), 'õ', 'o~') AS w FROM {words}),
n1 AS (SELECT *, {region(r1, 'r1')}, {region(r1 + r1, 'r2')}, {region(f'(?:.{c}+{v}|{v}{v}+{c}|{c}{v}.)', 'rv')},
              regexp_extract(w, '(?:{ends})$') AS s FROM n0),
n2 AS (SELECT *, left(w, length(w) - length(s)) AS b, length(w) - length(s) AS n FROM n1),
n3 AS (SELECT *, CASE
  WHEN s IN ({", ".join(map(lit, NOMINAL))}) AND n >= r2 THEN b
  WHEN s LIKE 'logia%' AND n >= r2 THEN b || 'log' WHEN s LIKE 'uç%' AND n >= r2 THEN b || 'u' WHEN s LIKE 'ência%' AND n >= r2 THEN b || 'ente'
  WHEN s = 'amente' AND n >= r1 THEN CASE WHEN suffix(b, 'ativ') AND n - 4 >= r2 THEN left(b, n - 4)
    WHEN right(b, 2) IN ('iv', 'os', 'ic', 'ad') AND n - 2 >= r2 THEN left(b, n - 2) ELSE b END
  WHEN s = 'mente' AND n >= r2 THEN CASE WHEN right(b, 4) IN ('ante', 'avel', 'ível') AND n - 4 >= r2 THEN left(b, n - 4) ELSE b END
  WHEN s LIKE 'idade%' AND n >= r2 THEN CASE WHEN suffix(b, 'abil') AND n - 4 >= r2 THEN left(b, n - 4)
    WHEN right(b, 2) IN ('ic', 'iv') AND n - 2 >= r2 THEN left(b, n - 2) ELSE b END
  WHEN s LIKE 'iv%' AND n >= r2 THEN CASE WHEN suffix(b, 'at') AND n - 2 >= r2 THEN left(b, n - 2) ELSE b END
  WHEN s LIKE 'ira%' AND n >= rv AND suffix(b, 'e') THEN b || 'ir' END AS x1 FROM n2),
n4 AS (SELECT *, regexp_extract(substr(w, rv + 1), '(?:{"|".join(VERBAL)})$') AS v, regexp_extract(w, '(?:os|a|i|o|á|í|ó)$') AS t FROM n3),
n5 AS (SELECT *, coalesce(x1, CASE WHEN v <> '' THEN left(w, length(w) - length(v)) END) AS x2 FROM n4),
n6 AS (SELECT *, CASE WHEN x2 IS NULL THEN CASE WHEN t <> '' AND length(w) - length(t) >= rv THEN left(w, length(w) - length(t)) ELSE w END
  WHEN suffix(x2, 'ci') AND length(x2) - 1 >= rv THEN left(x2, length(x2) - 1) ELSE x2 END AS x3 FROM n5),
n7 AS (SELECT *, CASE WHEN right(x3, 1) IN ('e', 'é', 'ê') AND length(x3) - 1 >= rv THEN
    CASE WHEN substr(x3, length(x3) - 2, 2) IN ('gu', 'ci') AND length(x3) - 2 >= rv THEN left(x3, length(x3) - 2) ELSE left(x3, length(x3) - 1) END
  WHEN suffix(x3, 'ç') THEN left(x3, length(x3) - 1) || 'c' ELSE x3 END AS x4 FROM n6)
SELECT token, replace(replace(x4, 'a~', 'ã'), 'o~', 'õ') AS stem FROM n7"""


def lemma_table(words: str) -> str:
    """(token, lemma) by the lexicon, or by the counted edit script of the longest suffix, as one query."""
    return f"""
WITH lex AS (SELECT * FROM (VALUES {values(LEMMAS + REGULAR)}) v(token, lemma)),
known AS (SELECT token, min(lemma) AS lemma FROM lex GROUP BY token),
edit AS (SELECT token, lemma, len(list_filter(range(1, least(length(token), length(lemma)) + 1), lambda i: left(token, i) = left(lemma, i))) AS p
         FROM (SELECT DISTINCT token, lemma FROM lex)),
script AS (SELECT right(token, k::INT) AS suf, cut, plus, count(*) AS n
           FROM (SELECT token, length(token) - p AS cut, substr(lemma, p + 1) AS plus,
                        unnest(range(greatest(length(token) - p, 1), least(6, length(token)) + 1)) AS k FROM edit)
           GROUP BY ALL HAVING count(*) >= 2),
rule AS (SELECT suf, cut, plus FROM script QUALIFY row_number() OVER (PARTITION BY suf ORDER BY n DESC, cut, plus DESC) = 1),
tail AS (SELECT token, k, right(token, k::INT) AS suf
         FROM (SELECT token, unnest(range(1, least(6, length(token)) + 1)) AS k FROM (SELECT DISTINCT token FROM {words}))),
best AS (SELECT token, left(token, (length(token) - cut)::INT) || plus AS lemma FROM tail JOIN rule USING (suf)
         WHERE length(token) - cut >= 3 AND token NOT IN (SELECT token FROM known)
         QUALIFY row_number() OVER (PARTITION BY token ORDER BY k DESC) = 1)
SELECT * FROM known UNION ALL SELECT * FROM best"""


def token_texts(table, new: str) -> str:
    """(doc_id, text) of the tokens of all documents without stop words, each by ``table``'s query over them."""
    tok = remove_stop_words(tokenize(normalise("text")))
    return f"""
WITH tok AS (SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS token FROM (SELECT doc_id, {tok} AS t FROM documents)),
tab AS ({table('tok')}),
txt AS (SELECT doc_id, string_agg(coalesce({new}, token), ' ' ORDER BY pos) AS txt FROM tok LEFT JOIN tab USING (token) GROUP BY doc_id)
SELECT doc_id, coalesce(txt, '') AS {new}_text FROM documents LEFT JOIN txt USING (doc_id)"""
