from chatloom.llm.pii import detect, learn_names, mask, masked, names_of, occurrences

NAMES = learn_names(["You", "Mira Talbot", "Mira", "Jonas hostel", "Anouk Vance-Reed", "+91 60000 13620"])


def kinds(text, labels=False):
    return [k for _, _, k in detect(text, NAMES, labels)]


def test_types():
    for t in ("write to m.talbot@example.org", "m dot talbot at example dot org pls", "MIRA+x [at] post [dot] example [dot] org", "mira9 @ example.com"):
        assert kinds(t) == ["EMAIL"], t
    for t in ("call +91 90000 93715", "9000099076", "(393) 555-0117", "0049 30 23125016", "07700 900799", "80000-62262", "old one nine zero zero zero zero two one eight six nine works", "９００００９９０７６"):
        assert kinds(t)[:1] == ["PHONE"], t
    for t in ("id 934-64-0232", "card QVPXM0127B", "u0522392", "0785-2100-3333", "117869232354", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"):
        assert kinds(t) == ["ID_NUMBER"], t
    for t in ("231 Harrow Hill Avenue", "Flat 24A, 123 Quarry Drive, Talshire", "H.No. 19-2/33, Marigold Lane, Oskwen 093473", "Calle del Olmo 193, 6º B", "Nordmühlenstraße 194", "plot no 126, sector 38, Navdurga Nagar", "229, ortel street, talshire", "Karl-Marx-Allee 3"):
        assert kinds("moved to " + t) == ["ADDRESS"], t
    for t in ("ask Mira", "ask mira talbot", "ask M. Talbot", "ask Mr Vance-Reed", "ask JONAS", "ask Dr. Unknown"):
        assert kinds(t) == ["NAME"], t


def test_no_cases():
    for t in ("order 01166429 ships in 3 days, total 4,726.00", "ticket PQ-551735", "version 2.0.62", "on 2025-06-14 at 18:30", "score 163-66 after 20 overs", "error code 0x7903 at line 884", "room 710, platform 6, coach B9", "one two three", "", None, "see you at noon dot", "Talbot called", "GB83WEST12345698765432", "meet at example.com", "polka dot, at night"):
        assert kinds(t) == [], t


def test_masking_keeps_the_rest():
    assert mask("give this to Mira: m.talbot@example.org, thanks 😀", NAMES) == "give this to [NAME]: [EMAIL], thanks 😀"
    assert mask("number nine zero zero zero zero two one eight six nine hai", NAMES) == "number [PHONE] hai"
    assert mask("wrіte to mirа@example.org now", NAMES) == "wrіte to [EMAIL] now"  # Cyrillic letters outside stay
    assert mask("Mira: ask Mira\nJonas hostel: fine\n+91 60000 13620: 9000099076", NAMES, True) == "Mira: ask [NAME]\nJonas hostel: fine\n+91 60000 13620: [PHONE]"


def test_operator(spark):
    d = spark.createDataFrame([("a", "Mira and Jonas, 9000099076", "x"), ("a", "Mira and Jonas, 9000099076", "y"), (None, "Mira", "z"), ("b", None, "z"), ("c", "plain " * 30000, "z")], "id string, text string, field_name string")
    got = sorted(tuple(r) for r in occurrences(d, "id", {"text": ("t.text", False)}, NAMES).distinct().collect())
    assert got == [("a", "t.text", "NAME", 1), ("a", "t.text", "NAME", 2), ("a", "t.text", "PHONE", 1)]
    m = {r["id"]: r["text_masked"] for r in masked(d.where("id = 'a'"), {"text": ("t.text", False)}, NAMES).collect()}
    assert m == {"a": "[NAME] and [NAME], [PHONE]"}
    assert occurrences(d.limit(0), "id", {"text": ("t.text", False)}, NAMES).count() == 0


def test_quiet_speakers_count(spark):
    # one row of 450,000 is enough for a name
    loud = spark.range(450_000).selectExpr("'Mira Talbot' as sender")
    few = spark.createDataFrame([("Zelda Quimby",), ("ze ta",), ("You",), ("",), (None,)], "sender string")
    n = names_of([(loud, "sender"), (few, "sender")])
    assert n.given == {"mira", "zelda"} and n.family == {"talbot", "quimby"} and n.speakers == {"You", "ze ta", ""}
    assert mask("Zelda Quimby: ask zelda quimby\nze ta: ask Mira", n, True) == "Zelda Quimby: ask [NAME]\nze ta: ask [NAME]"


def test_spans_of_disguises_point_home():
    for t, part in (("so m dot talbot at example dot org pls", "m dot talbot at example dot org"), ("x (at) y.org, mira [at] post (dot) io!", "mira [at] post (dot) io"), ("ｍira @ example.com", "ｍira @ example.com")):
        assert part in [t[a:b] for a, b, k in detect(t, NAMES) if k == "EMAIL"], t


def test_account_number_is_one_case():
    assert mask("pay DE89 3704 0044 0532 0130 00 now", NAMES) == "pay [ID_NUMBER] now"


def test_many_names():
    many = learn_names([f"{a}{b}{c} {a}{c}{b}x" for a in "ABCDEFG" for b in ("a", "an", "ana") for c in ("li", "lis", "l-o")])
    for w in ("ask Aanalis alisanx", "ask Ganali", "ask Mr Blianax"):
        assert [k for _, _, k in detect(w, many)] == ["NAME"], w
    assert detect("ask Aanalisa", many) == []
