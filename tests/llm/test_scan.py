from tidemark.llm.scan import _NUMBERISH, breaks_of, damage, fixed_number, furniture, may_be_number, page_number, pages_of, repair_texts, shape

PAGES = [
    "Acme Glass | Report 2024\nManagement said that the supply of sensors inve-\nstors should note grew by 1O.5 percent and the low-\n- 1 -",
    "ACME GLASS\ncarbon plan reached rnillion yuan. The supply is large and\nlow-carbon projects are a third-party matter.\n- 2 -",
    "Acme G1ass | Report 2024\nThe investors and the management agreed on it.\n- 3 -",
]
PLAIN = "The million investors and the supply of sensors. Low-carbon, low-carbon and third-party plans.\nManagement of a million yuan. The investors.\n"


def corpus(spark):
    rows = [(1, "Acme Glass", "\n\n".join(PAGES))]
    rows += [(10 + i, f"Firm{i} Ltd", f"FIRM{i} LTD    1\nThe million investors said something.\n\n{'Firm' + str(i)} Ltd | Report 2024    2\nThe management spoke.") for i in range(12)]
    rows += [(100 + i, None, PLAIN) for i in range(25)]
    rows += [(200, "n", None), (201, "n", ""), (202, None, " \n "), (203, "n", "word " * 20_000), (1, "Acme Glass", "\n\n".join(PAGES))]
    return spark.createDataFrame([(*r, "x", 0) for r in rows], "id bigint, who string, body string, kind string, text_ int")


def test_damage(spark):
    got = {(r.kind, r.item) for r in damage(corpus(spark), key="id", text="body", name="who").where("id = 1").collect()}
    assert ("hyphen", "investors") in got and ("hyphen", "low-carbon") in got
    assert ("misread", "10.5") in got and ("misread", "million") in got
    assert {i for k, i in got if k == "page_number"} == {"- 1 -", "- 2 -", "- 3 -"}
    assert {i for k, i in got if k == "header"} == {"Acme Glass | Report 2024", "ACME GLASS", "Acme G1ass | Report 2024"}


def test_each_case_once_and_clean_texts_are_clean(spark):
    all_cases = damage(corpus(spark), key="id", text="body", name="who").collect()
    assert len({(r.id, r.kind, r.item, r.raw) for r in all_cases}) == len(all_cases)
    assert not [r for r in all_cases if 100 <= r.id]
    assert {r.item for r in all_cases if r.id == 10} == {"FIRM0 LTD    1", "Firm0 Ltd | Report 2024    2"}


def test_repair(spark):
    out = {r.id: r.body for r in repair_texts(corpus(spark), key="id", text="body", name="who").collect()}
    assert "of sensors investors should note grew by 10.5 percent and the low-carbon plan reached million yuan." in out[1].replace("\n", " ")
    assert "Report 2024" not in out[1] and "- 2 -" not in out[1]
    assert out[200] is None and out[201] == "" and out[202] == " \n "
    assert out[100].split() == PLAIN.split()


def test_nothing(spark):
    assert damage(corpus(spark).limit(0), key="id", text="body", name="who").count() == 0
    assert repair_texts(corpus(spark).limit(0), key="id", text="body", name="who").count() == 0


def test_numbers_and_pages():
    assert [fixed_number(w) for w in ("I7.9Z", "2OZ4", "l,7l2.99", "1,234", "BS822576", "so", "ZOZS", "12.5", "b", "Bob")] == ["17.92", "2024", "1,712.99", None, None, None, "2025", None, None, None]
    assert [page_number(t) for t in ("- 1 -", "Page 20 of 23", "第 158 页 共 160 页", "—9—", "3/7", "p. 43", "l7", "[9]", "9.5", "total 9", "")] == [1, 20, 158, 9, 3, 43, 17, 9, None, None, None]
    assert shape("rnillion") == shape("million") and shape("powcler") == shape("powder") and shape("iipgraded") == shape("upgraded")


def test_amounts_at_page_edges_are_body():
    pages = pages_of("text here\nUnit: x\n17\n\n398\nmore text\n22\n\nlast\n5")
    assert "page_number" not in furniture(pages, [], {}).values()
    lines = [(0, "a half-"), (0, "way word"), (0, "dash -"), (1, "not a break")]
    assert breaks_of(lines) == [(0, "half", "-", "way")]


def test_long_running_lines_repeat_within_a_text(spark):
    foot = "This report was made for the registered holders of Acme Glass and may be passed on to no other person in any form at all"
    assert len(foot) > 80
    pages = [f"The management said that supply grew and the inves-\n{foot}", f"tors agreed on the plan of the year, it said\n{foot.replace('holders', 'ho1ders')}", f"Nothing else was said of it\n{foot}"]
    df = spark.createDataFrame([(1, None, "\n\n".join(pages)), (2, None, PLAIN)], "id bigint, who string, body string")
    got = {(r.kind, r.item) for r in damage(df, key="id", text="body", name="who").where("id = 1").collect()}
    assert {i for k, i in got if k == "header"} == {foot, foot.replace("holders", "ho1ders")}
    assert ("hyphen", "investors") in got


def test_common_words_change_no_result(spark):
    rows = [(1, "The supply of lO sensors and SOO plans was agreed in ZOZS by all."), (2, "The oil plan and the big oil supply were so good.")] + [(3 + i, PLAIN + "It sold 500 sensors in 2025.\n") for i in range(22)]
    df = spark.createDataFrame([(i, None, t) for i, t in rows], "id bigint, who string, body string")
    few, many = ({(r.id, r.kind, r.item, r.raw) for r in damage(df, key="id", text="body", name="who", common_words=n).collect()} for n in (1, 20_000))
    assert few == many and {x[1:] for x in many if x[0] == 1} >= {("misread", "10", "lO"), ("misread", "500", "SOO"), ("misread", "2025", "ZOZS")}


def test_every_misread_number_may_be_one():
    for w in ("lO", "SOO", "ZOZS", "I7.9Z", "2OZ4", "l,7l2.99", "bB6gq9"):
        assert _NUMBERISH.fullmatch(w) and may_be_number(w.lower())
    assert not may_be_number("supply") and not may_be_number("1,")


def cases(spark, texts, **options):
    df = spark.createDataFrame([(i, None, t) for i, t in enumerate(texts)], "id bigint, who string, body string")
    return {(r.id, r.kind, r.item) for r in damage(df, key="id", text="body", name="who", **options).collect()}


def test_words_in_capitals_are_no_numbers(spark):
    texts = [f"The plant holds the ISO mark and the BIS mark, as the OS said, SO it sold {150 + i} sensors of the boss." for i in range(30)]
    for common in (1, 20_000):
        assert not cases(spark, texts, common_words=common)
    assert (40, "misread", "150") in cases(spark, ["It sold 150 sensors."] * 40 + ["It sold ISO sensors."])


def test_a_page_number_needs_a_sequence(spark):
    plain = ["The supply was agreed upon\n(2019)\n\nNothing more was said of it"] * 3
    assert not cases(spark, plain)
    rising = "The supply was agreed upon\n(1)\n\nNothing more was said of it\n(2)"
    assert cases(spark, [rising]) == {(0, "page_number", "(1)"), (0, "page_number", "(2)")}
    # in a corpus that numbers its pages so, a number alone is one where the sequence has it
    alone = ["The supply was agreed upon\n(1)", *plain[:1]]
    assert cases(spark, [rising] * 6 + alone) >= {(6, "page_number", "(1)")}
    assert not {c for c in cases(spark, [rising] * 6 + alone) if c[:2] == (7, "page_number")}


def test_any_number_of_templates(spark):
    one, many = ({tuple(r) for r in damage(corpus(spark), key="id", text="body", name="who", max_broadcast=n).collect()} for n in (200_000, 0))
    assert one == many and len(one) > 10
