import re

from periodica.llm.pii import GIVEN, op6_pii, pseudonymised, surrogates

SF = "/root/testdata/sf0.01"


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def run(spark, texts, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in sorted(pseudonymised(docs, **more).collect(), key=lambda r: r.doc_id)]


def test_types_and_formats(spark):
    texts = [
        "mail Ann.Lee+7@Mail7.example.com, call +1 (269) 555-3296 or 269-555-3296.",
        "card 4111 1111 1111 1111 and 4041894974608796, ip 97.51.17.173; ssn 078-05-1120",
        "iban DE89 3704 0044 0532 0130 00!",
        "Mr. John Smith met Frau Greta MÜLLER, г-н Иван Петров and Dr Smith",
        "version 2.0, 12 apples, 1999-2004, 3.14159, see 1.2.3 or abc123def456",
    ]
    a, b, c, d, e = run(spark, texts)
    mail, phone, local = re.fullmatch(r"mail (\S+), call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\d{3}-\d{3}-\d{4})\.", a).groups()
    assert re.fullmatch(r"[a-z]{3}\.[a-z]{3}\+\d@[a-z]+\.example\.com", mail)
    assert phone != "+1 (269) 555-3296" and local != "269-555-3296"
    spaced, other, ip, ssn = re.fullmatch(
        r"card (\d{4} \d{4} \d{4} \d{4}) and (\d{16}), ip (\S+); ssn (\d{3}-\d{2}-\d{4})", b
    ).groups()
    assert spaced[0] == "4" and luhn(spaced.replace(" ", "")) and spaced != "4111 1111 1111 1111"
    assert other[0] == "4" and luhn(other) == luhn("4041894974608796")
    assert all(0 <= int(x) < 256 for x in ip.split(".")) and ip != "97.51.17.173" and ssn[0] == "9"
    assert re.fullmatch(r"iban DE\d\d( \d{4}){4} \d\d!", c) and c != texts[2]
    he, his, she, hers, ivan, his2, again = re.fullmatch(
        r"Mr\. (\S+) (\S+) met Frau (\S+) (\S+), г-н (\S+) (\S+) and Dr (\S+)", d
    ).groups()
    assert he.split("-")[0] in GIVEN["latin", "m"] and she.split("-")[0] in GIVEN["latin", "f"]
    assert ivan.split("-")[0] in GIVEN["cyrillic", "m"] and re.fullmatch("[А-Яа-я]+", his2)
    assert hers.isupper() and his == again != "Smith"
    assert e == texts[4]


def test_coreference_distinctness_and_key(spark):
    texts = [f"write to user{i}@a.example.com or +1 (212) 555-{i:04d}" for i in range(300)]
    texts += ["USER7@a.example.com", "call +1 212 555 0007", "call +1-212-555-0007"]
    out = run(spark, texts)
    mails = [re.search(r"\S+@\S+", x)[0] for x in out[:300]]
    phones = [re.sub(r"\D", "", x.split(" or ")[1]) for x in out[:300]]
    assert len(set(mails)) == len(set(phones)) == 300
    assert not set(mails) & {f"user{i}@a.example.com" for i in range(300)}
    assert out[300].lower() == mails[7]
    assert {re.sub(r"\D", "", x) for x in out[301:]} == {phones[7]}
    assert len({x.split("@")[1] for x in mails}) == 1
    assert run(spark, texts[:5], key="other") != out[:5] == run(spark, texts)[:5]


def test_collisions_draw_again(spark):
    names = [("given:latin:f", f"name{i}") for i in range(60)] + [("given:latin:f", "mary")]
    entities = spark.createDataFrame(names * 2, "kind string, canon string")
    found = surrogates(entities).collect()
    assert len(found) == 61 and len({r.surrogate for r in found}) == 61
    assert not {r.surrogate for r in found} & {c for _, c in names}


def test_query_leaves_the_rest_alone(spark):
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    after = {r.doc_id: r for r in op6_pii(spark, SF).collect()}
    assert after.keys() == before.keys()
    entity = re.compile(
        r"[\w.+-]+@[\w-]+\.[\w.]*\w|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w.])|(?<![\w-])\d{16}(?!\w)"
    )
    found: dict[str, set] = {}
    for i, text in before.items():
        old, new = entity.split(text), after[i].text
        # what stands between entities is unchanged and in order
        assert re.fullmatch(".+?".join(map(re.escape, old)), new, re.S), i
        assert after[i].n_entities == len(old) - 1 == sum(after[i].kinds.values())
        assert not any(own in new for own in entity.findall(text))
        for old_one, new_one in zip(entity.findall(text), entity.findall(new), strict=False):
            found.setdefault(old_one, set()).add(new_one)
    assert len(found) > 30 and all(len(x) == 1 for x in found.values())
    assert len({next(iter(x)) for x in found.values()}) == len(found)


def test_defined_results(spark):
    rows = [(1, None), (2, ""), (None, "a@b.de"), (3, "x " * 60_000 + "a@b.de"), (4, "a@b.de a@b.de"), (4, "a@b.de a@b.de")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, kind string")
    got = sorted(((r.doc_id or 0), r.text, r.n_entities) for r in pseudonymised(docs).collect() if r.text is not None)
    one = got[0][1]
    assert got == [(0, one, 1), (2, "", 0), (3, "x " * 60_000 + one, 1), (4, f"{one} {one}", 2), (4, f"{one} {one}", 2)]
    assert pseudonymised(docs).filter("text is null").count() == 1
    assert pseudonymised(docs.limit(0)).collect() == []


def test_plan_is_native(spark):
    plan = op6_pii(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
