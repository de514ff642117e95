import random

from chatloom.llm import langs as L
from chatloom.llm.pii import learn_names
from tests.conftest import rows

LANGS = ("en", "hi", "de", "es", "fr")
R = random.Random(2)
WORDS = {
    "en": "the house with when they should write about some other thing because nothing was ready before the long winter and our friends were late".split(),
    "de": "das haus mit wenn sie sollten schreiben über eine andere sache weil nichts fertig war vor dem langen winter und unsere freunde kamen spät".split(),
    "es": "la casa con cuando ellos deben escribir sobre alguna otra cosa porque nada estaba listo antes del largo invierno y nuestros amigos llegaron tarde".split(),
    "fr": "la maison avec quand ils doivent écrire sur une autre chose parce que rien était prêt avant le long hiver et nos amis arrivèrent tard".split(),
    "hi": "ghar ke saath jab unhe likhna chahiye kisi aur cheez ke baare mein kyunki kuch taiyaar nahi tha lambi sardi se pehle aur humare dost der se aaye".split(),
}


def sentence(c, n=12):
    return " ".join(R.choice(WORDS[c]) for _ in range(n)).capitalize() + "."


def document(*cs):
    return " ".join(sentence(c) for c in cs for _ in range(3))


def test_codes():
    assert [L.code_of(x) for x in ("EN", "en-IN", "hin", "hi-Latn", "deu", " fr_FR", "und", "", None)] == ["en", "en", "hi", "hi", "de", "fr", None, None, None]


def test_automaton_counts_pieces():
    a = L.Automata({"en": b" the cat sat "})
    assert a.pieces([b" the cat ", b" cat sat ", b" the sat ", b" zzz "]).ravel().tolist()[:3] == [1, 1, 2]
    assert a.pieces([]).shape == (0, 1)
    long = b" " + b"the cat sat " * 200
    assert a.pieces([long])[0, 0] > 100


def test_documents(spark):
    docs = [(k, document(c), c) for k, c in enumerate(LANGS * 12)]
    docs += [(k + 500, document(c), w) for k, (c, w) in enumerate([("de", "en"), ("fr", "en"), ("en", "hi"), ("hi", None), ("es", "und")])]  # wrong and missing labels
    docs += [(600, document("en", "de", "fr"), "en"), (601, "😂 12 👍", "en"), (602, None, "en"), (603, "", None), (604, "Ref Kubamar-17. " + document("es"), "es"), (605, document("en") * 60, "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    out = L.document_languages(df)
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r["doc_id"], r["segment_no"])):
        got.setdefault(r["doc_id"], []).append(r["language"])
        assert 0 <= r["confidence"] <= 1
    for k, t, c in docs[:60]:
        assert got[k] == [c]
    assert [got[k] for k in (500, 501, 502, 503, 504, 600, 604)] == [["de"], ["fr"], ["en"], ["hi"], ["es"], ["en", "de", "fr"], ["es"]]
    assert not {601, 602, 603} & got.keys() and got[605] == ["en"]
    assert L.document_languages(df.limit(0), machine=L.fit_documents(L.document_sample(df))).count() == 0


SCRIPTS = {
    "ru": "дом вместе когда они должны писать про какую другую вещь потому что ничего было готово перед долгой зимой наши друзья пришли поздно".split(),
    "mr": "घर सोबत जेव्हा त्यांनी लिहावे दुसऱ्या गोष्टी बद्दल कारण काहीही तयार नव्हते लांब हिवाळ्या आधी आमचे मित्र उशिरा आले".split(),
    "zh": "房子 我们 应该 写 关于 其他 事情 因为 没有 准备 好 漫长 冬天 之前 朋友 来 晚".split(),
}


def test_any_script_and_any_label():
    said = {**WORDS, **SCRIPTS}
    text = lambda c: ". ".join(" ".join(R.choice(said[c]) for _ in range(12)) for _ in range(3)) + "."
    m = L.fit_documents({c: [text(c) for _ in range(14)] for c in said})
    assert m.names == sorted(said)

    def got(t):
        parts = [L.letters(x) for x in L.sentences(t)]
        return [(c, f) for c, f, _, _ in L.stretches(m, m.pieces(parts), [len(x) for x in parts])]

    for c in said:
        assert [x for x, _ in got(text(c))] == [c], c
    assert [c for c, _ in got(text("ru") + "\n" + text("en") + "\n" + text("mr"))] == ["ru", "en", "mr"]
    # a script that no label covers has no language; a short text has one with less confidence than a long one
    assert got("ສະບາຍດີ ທ່ານສະບາຍດີບໍ ມື້ນີ້ອາກາດດີຫຼາຍ") == []
    (c, low), = got("weil nichts fertig war")
    (_, high), = got(text("de") * 3)
    assert c == "de" and 0 < low < 1 and high > 0.3
    assert got("12 👍") == [] and got("") == []


def test_wrong_labels_do_not_speak_for_each_other():
    good = {c: [document(c) for _ in range(20)] for c in LANGS}
    stray = document("en", "en")
    good["hi"] += [stray, stray + " " + sentence("en"), sentence("en") + " " + stray]
    m = L.fit_documents(good)
    assert L.letters(L.sentences(stray)[0]) not in m.clean["hi"]


def test_without_labels(spark):
    df = spark.createDataFrame([(1, "some text here", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert L.document_languages(df).count() == 0


def test_turns(spark):
    names = learn_names(["You", "Mira Talbot"])
    turns = []
    for k in range(900):
        c = R.choice(["pure_english", "pure_hindi", "code_switched"])
        e, h = " ".join(R.sample(WORDS["en"], 5)), " ".join(R.sample(WORDS["hi"], 5))
        t = {"pure_english": e, "pure_hindi": h, "code_switched": f"{e}, {h}"}[c]
        turns.append((k, t + R.choice(["", " 😂", " lol", " Mira", "!!!"]), c if R.random() > 0.08 else R.choice(L.CLASSES), c))
    turns += [(2000 + k, t, R.choice([None, "neutral"]), "neutral") for k, t in enumerate(["ok", "haha", "12", "😂😂", "Mira Talbot", "m.talbot@example.org", ""])]
    df = spark.createDataFrame(turns, "message_uid long, text string, classification string, truth string")
    docs = L.fit_documents({c: [document(c) for _ in range(10)] for c in LANGS})
    out = L.turn_classes(df.select("message_uid", "text", "classification"), names, docs)
    truth = {r[0]: r[3] for r in turns}
    wrong = [r for r in out.collect() if r["class"] != truth[r["message_uid"]]]
    assert len(wrong) <= 5, wrong[:5]
    assert rows(L.turn_classes(df.where("false").select("message_uid", "text", "classification"), names, docs)) == []
