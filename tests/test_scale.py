"""Steps whose work must not grow faster than their input, against plain versions."""

import random

from pyspark.sql import functions as F

from recordweave.operators import joins as J


def test_numbers_meet_on_more_than_their_last_digits(spark):
    rng = random.Random(7)
    needles = sorted({f"{rng.choice((12, 22, 412))}{rng.randrange(100):05d}001" for _ in range(80)} | {"001", "5001", "1200001", "ps-12", "ab", "7" * 14})
    hay = [f"supplier#{rng.randrange(3000)}({x})" for x in needles] + ["ps-12", "x" + "7" * 20, "", "1200", "0001"]
    out = J.substring_join(spark.createDataFrame([(x,) for x in needles], "needle string"), spark.createDataFrame([(x,) for x in hay], "hay string"), "needle", "hay")
    assert sorted(tuple(r) for r in out.select("needle", "hay").collect()) == sorted((a, b) for a in needles for b in hay if len(a) >= 3 and a in b)
    plan = out._jdf.queryExecution().toString()
    assert all(f"[0-9]{{{n},}}" in plan for n in (3, 6, 9, 12))


def test_gates_look_for_a_text_first_and_lose_no_match(spark):
    import re

    from recordweave.plans import gates as G

    rng = random.Random(11)
    bits = ["REWARI", "Rewa", "bhadla-II", "Hero  Future", "renew", "Pvt. Ltd", "llp", "1212345678", "0412345678", "ST-II", "st ii", "LTA :", "Land BG Route", "SECI LOA", "Alpha Beta (PG)", "x (PGCIL)", "Bulk consumer", "GNARE", "MW", "\n", "Project", "Location", "Status", "İD", "ID", "wind", "Bess", "solar + BESS", "5.2", "enhancement"]
    texts = [rng.choice((" ", "  ", ", ")).join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(999, None)], "i int, t string")
    got = {r[0]: (r[1], r[2]) for r in df.select("i", G.value_columns(F.col("t")), G.has_values(F.col("t"), "substation")).collect()}
    for i, t in enumerate(texts):
        want = sorted(n for n, ps in G.VALUES.items() if sum(len(re.findall("(?ai)" + p, t)) for p in ps) >= 2)
        assert got[i] == (want, "substation" in want), t
    assert got[999] == ([], False)
    assert G.needed(r"\b(?:12|22)\d{8}\b") == ("12", "22") and G.needed(r"\bLand\s+(?:BG\s+)?Route\b") == ("route",) and G.needed(r"a*|b") == ()


def test_meeting_dates_read_their_text_once(spark):
    from recordweave.functions import numbers as V

    texts = ["held on 5th  March 2024 and 6 april 2025", "112 november 2025", "No. 12 of may 7, 2031", "45 june 2020 or Jul 9 2021", "sept 4 2020", "", None]
    out = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", V.meeting_date(F.reverse(F.reverse("t"))).alias("d"))
    assert [r.d for r in out.orderBy("i").collect()] == ["05.03.2024", "12.11.2025", "07.05.2031", "09.07.2021", None, None, None]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("reverse(reverse(") == 1


def test_similarity_of_texts_that_hold_each_other_is_difflibs():
    import difflib

    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("ab c") for _ in range(n))
    for _ in range(500):
        x = word(rng.randint(0, 12))
        y = rng.choice([word(5) + x, x + word(3), word(9), x, word(250), "ab" * 120 + x])
        for a, b in ((x, y), (y, x)):
            assert J.ratio(a, b) == (difflib.SequenceMatcher(None, a, b).ratio() if a and b else 0.0)
    assert J.ratio(None, "a") == 0.0


def test_runs_that_no_longer_name_has_leave_a_name_out(spark):
    rng = random.Random(5)
    part = lambda: rng.choice(("customer", "abc", "power", "xy", "ab"))
    name = lambda: " ".join(part() for _ in range(rng.randint(1, 3))) + rng.choice(("", " Ltd.", " (50)"))
    left = spark.createDataFrame([(i, name(), rng.choice(("220kv", "400kv"))) for i in range(60)], "row_id int, developer string, voltage_key string")
    ents = spark.createDataFrame([(rng.choice(("220kv", "400kv")), f"{name()}; {name()}", str(i)) for i in range(40)], "voltage_key string, entity_name string, bay_no string")
    plain, blocked = (J.name_join(left, ents, blocked=b).select("row_id", "bay_no") for b in (False, True))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, blocked.collect()))
    assert "SortMergeJoin" not in blocked._jdf.queryExecution().executedPlan().toString().split("parquet")[0] and blocked.count() > 0


def test_technologies_and_dates_read_their_text_once(spark):
    from recordweave.functions import numbers as V

    df = spark.createDataFrame([("Solar (300) + BESS (19) + solar (2)", "05/06/2024"), ("hybrid", "on 2 March 2021"), (None, None)], "t string, d string")
    once = F.lower(F.reverse(F.reverse("t")))
    out = df.select(*[V.technology_struct(once)[x].alias(x) for x in ("solar",)], V.parse_date(F.trim(F.reverse(F.reverse("d")))).cast("string").alias("d"))
    assert [tuple(r) for r in out.collect()] == [(302.0, "2024-06-05"), (None, "2021-03-02"), (None, None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("reverse(reverse(t") == 1 and plan.count("reverse(reverse(d") <= 3


def test_best_match_scores_few_pairs_and_loses_none(spark, monkeypatch):
    import difflib

    import pandas as pd

    rng = random.Random(9)
    for _ in range(3000):
        x, y = ("".join(rng.choice("ab 12") for _ in range(rng.randint(0, n))) for n in (20, rng.choice((30, 230))))
        assert J.ratio(x, y) == (difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0)

    # a third of all substations is alike, as in the made-up tables; other names are alike, empty or without any match
    stations = lambda n: rng.choice([f"PS-{rng.randrange(n)}"] * 6 + ["N/A", "", None, "Power Station " + "x" * rng.randrange(90)])
    left = [(str(i), stations(9), rng.choice([f"Applicant {rng.randrange(40)}", f"Supplier#{rng.randrange(9)} (1200000{rng.randrange(999)})", "", "zzz"])) for i in range(60)]
    rows = [(i, stations(300), rng.choice([f"Supplier#{rng.randrange(90)} ({1200000000 + i})", "", "Applicant 7"])) for i in range(400)]
    monkeypatch.setattr(J, "RECORDS", 3)
    monkeypatch.setattr(J, "CANDIDATES", 20)
    monkeypatch.setattr(J, "PARTS", (0.9,))
    monkeypatch.setattr(J, "FEW", 0)
    none = spark.createDataFrame([], "left_id string, row_idx int, id_hits long")
    out = J.best_match(spark.createDataFrame(left, "left_id string, substation string, developer string"), spark.createDataFrame(rows, "row_idx int, pooling_station string, connectivity_applicant string"), none)
    assert "NestedLoop" not in out._jdf.queryExecution().toString() and "Cartesian" not in out._jdf.queryExecution().toString()
    got = {r.left_id: (r.row_idx, r.score) for r in out.collect()}

    def part(a, b):
        a, b = (a or "").strip().lower(), (b or "").strip().lower()
        s = difflib.SequenceMatcher(None, a, b).ratio() if a and b else 0.0
        return min(1.0, s + (0.15 if a and b and (a in b or b in a) else 0.0))

    want = {}
    for i, s, d in left:
        score, k = max((0.5 * part(s, p) + 0.5 * part(d, c), -k) for k, p, c in rows)
        if score >= 0.45:
            want[i] = (-k, score)
    assert got == want and len({round(s, 1) for _, s in want.values()}) > 2

    scored = []
    monkeypatch.setattr(J, "ratio", lambda x, y, plain=J.ratio: scored.append(x) or plain(x, y))
    cands = pd.DataFrame({"row_idx": range(3000), "value": [1.0 - k % 3 / 10 for k in range(3000)], "other": [f"supplier#{k % 100} ({1200000000 + 37 * k})" for k in range(3000)]})
    found = J.best_of_block(pd.DataFrame({"text": ["applicant 5183"], "best": [0.45]}), cands)
    assert len(found) == 1 and len(scored) < 150  # of 3,000 pairs


def test_batched_ratios_are_difflibs(monkeypatch):
    import difflib

    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("ab c1é\0\U0001f600") for _ in range(rng.randint(0, n)))
    pairs = [(rng.choice([None, "", word(20), word(300)]), rng.choice([None, "", word(9), word(30), word(80), word(250)])) for _ in range(1500)] + [("ab", "xabx"), ("abx", "ab")]
    want = [difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in pairs]
    alone = []
    monkeypatch.setattr(J, "BATCH", 100)
    monkeypatch.setattr(J, "ratio", lambda x, y, plain=J.ratio: alone.append((x, y)) or plain(x, y))
    assert J.ratios(*map(list, zip(*pairs))).tolist() == want
    assert alone and all(len(x) > J.LONGEST or len(y) > J.BITS for x, y in alone)
    assert J.ratios([], []).tolist() == []


def test_best_of_block_works_out_few_ratios_and_takes_the_first_best(monkeypatch):
    import pandas as pd

    rng = random.Random(8)
    word = lambda n: rng.choice(["", "zz", "".join(rng.choice("ab c1") for _ in range(rng.randrange(1, n)))])
    for n in (6, 30, 290):
        for pairs in (1, 60, 250_000):
            monkeypatch.setattr(J, "PAIRS", pairs)
            records = [(x, rng.choice((0.45, 0.5, 0.7))) for x in {word(n) for _ in range(25)}]
            cands = [(k, rng.choice((1.0, 0.9, 0.5)), word(n)) for k in rng.sample(range(500), 40)]
            want = {}
            for text, least in records:
                score = lambda v, x: 0.5 * v + 0.5 * min(1.0, J.ratio(text, x) + (J.BONUS if text and x and (x in text or text in x) else 0.0))  # noqa: B023,E731
                best, k = max((score(v, x), -k) for k, v, x in cands)
                if best >= least:
                    want[text] = (best, -k)
            found = J.best_of_block(pd.DataFrame(records, columns=["text", "best"]), pd.DataFrame(cands, columns=["row_idx", "value", "other"]))
            assert {r.text: (r.score, r.row_idx) for r in found.itertuples()} == want

    worked_out = []
    monkeypatch.setattr(J, "matchings", lambda at, m, n, plain=J.matchings: worked_out.append(len(m)) or plain(at, m, n))
    cands = pd.DataFrame({"row_idx": range(3000), "value": 1.0, "other": [f"supplier#{k % 100} ({1200000000 + 37 * k})" for k in range(3000)]})
    assert len(J.best_of_block(pd.DataFrame({"text": [f"applicant {k}" for k in range(5000, 5050)], "best": 0.45}), cands)) == 50
    assert sum(worked_out) < 5_000 and len(worked_out) < 60  # of 150,000 pairs, in few batches


def test_records_meet_the_rows_of_their_identifier_once(spark, monkeypatch):
    from recordweave.plans import jobs

    rng = random.Random(12)
    rows = [(i, f"Supplier#{i % 5} ({9_000_000 + i // (2 if i < 20 else 1)})", f"PS-{i % 7}", "5 MW; 7 MW", rng.choice(("Effective", "Not effective"))) for i in range(60)]
    records = [(rng.choice([None, "", "12", "-", "nowhere77", f" 90000{rng.randrange(60):02d}"]), rng.choice([None, "", f"Applicant {rng.randrange(9)}", "Supplier#3"]), rng.choice([None, " ", f"PS-{rng.randrange(9)}"])) for _ in range(300)]
    left = spark.createDataFrame(records * 2, "application_id string, name_of_applicant string, substation string")
    right = spark.createDataFrame(rows, "row_idx int, connectivity_applicant string, pooling_station string, schedule_text string, status_text string")
    got = []
    for most in (J.BROADCAST_ROWS, 0):  # rows of an identifier that several have: few, or ranked with all others
        monkeypatch.setattr(J, "BROADCAST_ROWS", most)
        out = jobs.coordination_layer(left, right)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_extract_all" not in plan and "NestedLoop" not in out._jdf.queryExecution().toString()  # capacities are made for each row before
        got.append(sorted(map(tuple, out.collect()), key=str))
    assert got[0] == got[1]

    def one(a, b):
        a, b = a.strip().lower(), b.strip().lower()
        return min(1.0, J.ratio(a, b) + (0.15 if a and b and (a in b or b in a) else 0.0))

    want = []
    for id_, name, sub in {(i, n or "", (s or "").strip()) for i, n, s in records}:
        if not (id_ or name or sub):
            continue
        hit = [r for r in rows if id_ and len(id_.strip()) > 2 and id_.strip() in r[1]]
        score, k = max((0.5 * one(sub, r[2]) + 0.5 * one(name, r[1]), -r[0]) for r in hit or rows)
        row = rows[-k] if hit or score >= 0.45 else None
        value = row and [12.0 if row[4] == "Effective" else None, 0.0 if row[4] != "Effective" else None]
        want.append(("|".join(x for x in (id_, name, sub) if x is not None), row and row[0], row and int(bool(hit)), row and round(score, 9), name or (row and row[1]), sub or (row and row[2]), row and value[0]))
    assert [x[:7] for x in got[0]] == sorted(want, key=str) and len({x[2] for x in want}) == 3
