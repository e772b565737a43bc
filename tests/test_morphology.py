"""Stems, lemma scripts and other scripts against hand-made and literal values."""

from lexicarve.functions.lexicon import LEMMAS, REGULAR_LEMMAS
from lexicarve.functions.romanize import letter_table, romanize
from lexicarve.operators import morphology as mo
from lexicarve.operators import text as ot

LEXICON = [*LEMMAS, *zip(REGULAR_LEMMAS[::2], REGULAR_LEMMAS[1::2])]
# Words and stems of the published sample vocabulary, and words for each rule.
STEMS = dict(zip("""boa boainain boas bôas boassu boataria boate boates boatos bob bobagem bobagens bobalhões bobear bobeira
quilométricas quilométricos quilômetro quilômetros quilos químicas químico nação rapidamente realidade comunicação
felizmente carinhosamente existência segue ciência""".split(),
                 """boa boainain boas bôas boassu boat boat boat boat bob bobag bobagens bobalhõ bob bobeir
quilométr quilométr quilômetr quilômetr quil químic químic naçã rapid realidad comunic
feliz carinh existent seg ciênc""".split()))


def test_stems_of_known_words(spark):
    df = spark.createDataFrame([(w,) for w in STEMS], "token string")
    assert {r.token: r.stem for r in mo.stems(df).collect()} == STEMS


def test_stems_of_empty_and_odd_tokens(spark):
    df = spark.createDataFrame([("",), (None,), ("a",), ("!",), ("12",), ("ABACAXIS",), ("x" * 5000,)], "token string")
    assert [r.stem for r in mo.stems(df).collect()] == ["", None, "a", "!", "12", "abacax", "x" * 5000]


def test_unseen_regular_forms_resolve(spark):
    lexicon = ot.lexicon_table(spark, LEXICON)
    want = {"tables": "table", "berries": "berry", "jumped": "jump", "climbing": "climb", "dresses": "dress",
            "cachorros": "cachorro", "emocoes": "emocao", "mensagens": "mensagem", "dancando": "dancar", "pulava": "pular"}
    words = spark.createDataFrame([(w,) for w in [*want, *want, "was", "qwx", "", None, "!"]], "token string")
    rows = mo.lemma_table(words, lexicon, mo.lemma_rules(lexicon)).collect()
    got = {r.token: r.lemma for r in rows}
    assert len(rows) == len(got) and got["was"] == "be" and not {"qwx", "", None, "!"} & set(got)
    assert {w: got.get(w) for w in want} == want


def test_scripts_thin_out_by_support(spark):
    pairs = [("abcs", "abc"), ("xys", "xy"), ("pqz", "pq"), ("", "x")]
    rules = {r.suffix: (r.cut, r.add) for r in mo.lemma_rules(ot.lexicon_table(spark, pairs)).collect()}
    assert rules == {"s": (1, "")}
    assert mo.lemma_rules(ot.lexicon_table(spark, [])).count() == 0


def test_replaced_tokens_keep_the_others(spark):
    long = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "doc_id long, pos int, token string")
    table = spark.createDataFrame([("a", "z")], "token string, stem string")
    assert sorted(map(tuple, mo.replace_tokens(long, table, "stem").select("pos", "token").collect())) == [(0, "z"), (1, "b")]


def test_mixed_scripts(spark):
    rows = {"Ελλάδα, Αθήνα": "Ellada, Athena", "Юрий Щёкин; ёж": "Iurii Shchiokin; iozh", "한국어 서울": "hangugeo seoul",
            "Ação ß ﬁ Ærø": "Acao ss  AEro", "漢字 ok": " ok", "áe": "ae", "": "", None: None, "plain": "plain", "힣가": "hihga"}
    df = spark.createDataFrame([(k,) for k in rows], "t string")
    assert [r[0] for r in df.select(romanize("t")).collect()] == list(rows.values())


def test_every_syllable_is_spelled(spark):
    syllables = spark.createDataFrame([(chr(c),) for c in range(0xAC00, 0xD7A4)], "t string")
    spelled = syllables.select(romanize("t").alias("r"))
    assert spelled.where("r = '' or r rlike '[^a-z]'").count() == 0


def test_letters_spell_in_ascii():
    assert all(v.isascii() and v for v in letter_table().values())
