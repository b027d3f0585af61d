import duckdb
import regex

from spindle.llm import queries as registered
from spindle.llm import template_decon as T

NUMBERS, UNITS = set(T.NUMBER_WORDS), set(T.UNITS)


def plain_forms(text):
    """(template, case-free form, value) of every token."""
    text = regex.sub(r"([\p{L}\p{N},;]) (\p{Lu})", "\\1 \x02\\2", text or "")
    text = regex.sub(r"([\p{L}\p{N},;])[\t-\r\p{Z}]+(\p{Lu})", "\\1 \x03\\2", text)
    marked = regex.findall(r"[\x02\x03]?[\p{L}\p{M}]+|[0-9]+(?:[.,:/][0-9]+)*|[%$€£¥°]", text.lower())
    toks = [t.lstrip("\x02\x03") for t in marked]
    number = lambda t: t[0] in "0123456789" or t in NUMBERS
    out = []
    for i, t in enumerate(toks):
        free = "<num>" if number(t) else "<unit>" if t in "%$€£¥°" or i and number(toks[i - 1]) and t in UNITS else t
        out.append(("<name>" if free == t and marked[i][0] == "\x02" else free, free, t))
    return out


def plain_windows(text):
    """(position, form, window, slot values, template) of every window."""
    toks = plain_forms(text)
    for i in range(len(toks) - 4):
        w = toks[i:i + 5]
        first, free = tuple(t[0] for t in w), tuple(t[1] for t in w)
        yield i, 1, first, tuple(t[2] for t in w if t[0] != t[2]), first
        if free != first:
            yield i, 2, free, tuple(t[2] for t in w if t[1] != t[2]), first


def agreement(pairs):
    votes = {}
    for a, b in pairs:
        votes.setdefault(a, []).append(b)
    total = sum(map(len, votes.values()))
    return sum(max(v.count(x) for x in v) for v in votes.values()) / total if total else None


def plain_pairs(docs, items):
    """The whole rule: shares of windows in either form, votes of the document
    and of each occurrence."""
    bench = {}
    for item, text in {(i, t or "") for i, t in items}:
        named = [w for w in plain_windows(text) if sum(t[0] == t[2] for t in plain_forms(text)[w[0]:w[0] + 5]) >= 3]
        if named:
            bench.setdefault(item, []).append(named)
    out = set()
    for doc_id, text in docs:
        have = list(plain_windows(text))
        for item, texts in bench.items():
            templates = {w[4] for own in texts for w in own}
            by = {}
            for n, own in enumerate(texts):
                for pos, form, key, slots, template in own:
                    by.setdefault(key, []).append((form, slots, n, pos, template))
            met = [(pos, slots, place) for pos, _, key, slots, _ in have for place in by.get(key, [])]
            best = {}
            for _, _, (form, _, _, _, template) in met:
                best[template] = min(best.get(template, 2), form)
            if len(best) < 0.8 * len(templates):
                continue
            alone = sum(f == 1 for f in best.values()) >= 0.8 * len(templates)
            whole = [(a, b) for pos, key_slots, place in met if place[0] == 1 or not alone
                     if place == min(by[next(k for k, v in by.items() if place in v)])
                     for a, b in zip(place[1], key_slots, strict=True)]
            found = [agreement(whole)]
            if found[0] is None:
                out.add((doc_id, item))
                continue
            for n, own in enumerate(texts):
                places = len({w[0] for w in own})
                near = max(1, places // 4)
                here = [(pos - place[3], place[3], slots, place[1]) for pos, slots, place in met if place[2] == n]
                for band in (lambda o: o, lambda o: o // near, lambda o: (o + near // 2) // near):
                    for at in {band(o) for o, *_ in here}:
                        group = [(p, s, a) for o, p, s, a in here if band(o) == at]
                        if len({p for p, *_ in group}) >= 0.8 * places:
                            got = agreement([(x, y) for _, s, a in group for x, y in zip(a, s, strict=True)])
                            found.append(1.0 if got is None else got)
            if max(found) >= 0.8:
                out.add((doc_id, item))
    return out


QUESTION = ("On Monday the farmer Alice Carter sold 12 kg of apples for 30 dollars each week, and after 4 weeks she had earned "
            "enough to buy a cart from Bob that cost 96 dollars. How many apples did Alice sell in all?")
OTHER = ("On Friday the farmer Maria Lopez sold 15 kg of apples for 45 dollars each week, and after 6 weeks she had earned "
         "enough to buy a cart from Jim that cost 270 dollars. How many apples did Maria sell in all?")
# The same template, but one value of the question stands for two here.
MIXED = OTHER.replace("did Maria", "did Nadia").replace("cost 270 dollars", "cost 270 euros")


def pairs(docs, bench):
    return {(r.doc_id, r.item_id) for r in T.contaminated(docs, bench).collect()}


def test_templates(spark):
    df = spark.createDataFrame([(1, QUESTION), (2, "He paid $5, or 3.5 % of 1,200 euros; then Anna left. Units: km.")], "doc_id long, text string")
    line = T.typed(T.tokens(df["text"]))
    got = {r.doc_id: r for r in df.select("doc_id", T.template(line).alias("c"), T.case_free(line).alias("free")).collect()}
    assert got[1].c[:14] == ["on", "<name>", "the", "farmer", "<name>", "<name>", "sold", "<num>", "<unit>", "of", "apples", "for", "<num>", "<unit>"]
    assert got[2].c == ["he", "paid", "<unit>", "<num>", "or", "<num>", "<unit>", "of", "<num>", "<unit>", "then", "<name>", "left", "units", "km"]
    assert got[1].free[:6] == ["on", "monday", "the", "farmer", "alice", "carter"]
    assert [(x, y) for x, y, _ in plain_forms(QUESTION)] == list(zip(got[1].c, got[1].free, strict=True))


def test_reparameterised_questions(spark):
    bench = spark.createDataFrame([(7, QUESTION), (8, "too short"), (9, "1 2 3 4 5 6 7 8"), (10, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Before. " + OTHER + " After."), (2, QUESTION.lower()), (3, "Some clean words about apples and a farmer each week."),
                                  (4, QUESTION[:60]), (5, "9 8 7 6 5 4 3 2 1 too short"), (6, None), (None, QUESTION)], "doc_id long, text string")
    assert pairs(docs, bench) == {(1, 7), (2, 7), (None, 7)}


def plant(sep=" "):
    """Copies of QUESTION in every case, alone and inside other text."""
    made = [f(QUESTION) for f in (str, str.lower, str.upper, str.title, str.swapcase, str.capitalize)]
    around = ["%s", "Clean words come first, in some number of them. %s And clean words after it.", "clean words, all lower, then %s and others",
              "CLEAN WORDS IN CAPITALS. %s"]
    return [a % m.replace(" ", sep) for m in made for a in around]


def test_copies_in_any_case(spark):
    bench = spark.createDataFrame([(7, QUESTION)], "item_id long, text string")
    texts = plant() + plant("\n") + plant("  ")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert pairs(docs, bench) == {(i, 7) for i in range(len(texts))}
    # Another question of the same template in lower case has other words as
    # names, but one with other numbers is the same question asked again.
    other = QUESTION.replace("12", "13").replace("30", "31").replace("96", "97")
    docs = spark.createDataFrame([(1, other.lower()), (2, other), (3, OTHER), (4, "a text of clean words about apples. " * 9)], "doc_id long, text string")
    assert pairs(docs, bench) == {(1, 7), (2, 7), (3, 7)}


def test_whole_rule_against_sql_and_a_plain_version(spark, small_docs, tmp_path):
    """Planted items with numbers, names and units, so that slots are held
    against each other, in Spark, DuckDB and Python."""
    shop = "The shop of Anna has 10 pens and 10 pads, so 10 pens of Anna cost as much as 10 pads of Anna do today."
    boxes = ("Here the red box holds 12 small pens in it and then the red box holds 30 small pens in it and then "
             "the red box holds 55 small pens in it so how many small pens are there in all of them")
    swap = boxes.replace("12", "13").replace("30", "12")
    texts = [*plant(), OTHER, MIXED, OTHER.lower(), QUESTION + " Next. " + OTHER, OTHER + " Next. " + MIXED, shop, shop.replace("10", "25").replace("Anna", "Olaf"),
             "The shop of Olaf has 25 pens and 31 pads, so 47 pens of Nora cost as much as 52 pads of Mark do today.", shop.upper(), boxes, swap, shop.replace("pens", "cups"),
             boxes.lower() + " " + swap, boxes.replace("in it", "in It"), boxes.replace(" and", " and nice", 1), "Two Boxes hold Six Kg of flour and five kg of salt for the cook",
             "two boxes hold 7 kg of flour and Nine Kg of salt for the cook", None, "", "one two three four five six"]
    bench = [(1, QUESTION), (2, shop), (3, boxes), (6, shop.replace("pens", "cups")), (6, shop.replace("pens", "cups").replace("10", "77")), (4, "Two boxes hold six kg of flour and five kg of salt for the cook"), (5, None), (5, "1 2 3 4 5 6 7")]
    docs = [(i, t) for i, t in enumerate(texts)] + [(0, "clean words " * 9)] + [(-r.doc_id - 1, r.text) for r in small_docs.limit(40).collect()]
    want = plain_pairs(docs, bench)
    schema = "doc_id long, text string"
    d, b = spark.createDataFrame(docs, schema), spark.createDataFrame(bench, "item_id long, text string")
    assert pairs(d, b) == want and {i for _, i in want} == {1, 2, 3, 4, 6}
    d.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    b.coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    got = registered.op4_template_decontamination(spark, str(tmp_path))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    rows = con.execute(registered.OP4_SQL)
    names = [c[0] for c in rows.description]
    by_name = lambda r: tuple(r[c] for c in ("doc_id", "item_id", "n_windows", "n_matched", "n_slots"))
    sql = sorted(by_name(dict(zip(names, r, strict=True))) for r in rows.fetchall())
    assert sorted(by_name(r.asDict()) for r in got.collect()) == sql
    assert any(r[4] for r in sql)


def test_slots_must_agree(spark):
    question = "The shop of Anna has 10 pens and 10 pads, so 10 pens of Anna cost as much as 10 pads of Anna do today."
    agree = question.replace("10", "25").replace("Anna", "Olaf")
    differ = "The shop of Olaf has 25 pens and 31 pads, so 47 pens of Nora cost as much as 52 pads of Mark do today."
    bench = spark.createDataFrame([(1, question)], "item_id long, text string")
    docs = spark.createDataFrame([(1, agree), (2, differ)], "doc_id long, text string")
    assert pairs(docs, bench) == {(1, 1)}


def test_each_occurrence_is_judged(spark):
    boxes = ("Here the red box holds 12 small pens in it and then the red box holds 30 small pens in it and then "
             "the red box holds 55 small pens in it so how many small pens are there in all of them")
    other = boxes.replace("12", "13").replace("30", "31").replace("55", "56")
    mixed = boxes.replace("12", "13").replace("30", "31").replace("55", "56").replace("pens", "pads")
    bench = spark.createDataFrame([(1, QUESTION), (2, boxes)], "item_id long, text string")
    docs = spark.createDataFrame([(1, QUESTION + " Next. " + OTHER), (2, OTHER + " Next. " + OTHER.replace("15", "16").replace("Maria", "Nadia")),
                                  (3, "Before. " + boxes), (4, other + " Next. " + boxes), (5, other), (6, mixed),
                                  (7, OTHER.replace("of apples", "of nice apples") + " Next. " + QUESTION.replace("of apples", "of nice apples")),
                                  (8, "Some words. " + OTHER + " Next. " + QUESTION[:90])], "doc_id long, text string")
    assert pairs(docs, bench) == {(1, 1), (2, 1), (3, 2), (4, 2), (5, 2), (7, 1), (8, 1)}


def test_other_case_and_white_space(spark):
    plain = "the little boat had gone over the wide sea when a storm came and all the men in it were lost for good"
    bench = spark.createDataFrame([(1, QUESTION), (2, plain)], "item_id long, text string")
    numbers = QUESTION.replace("12", "13").replace("30", "31").replace("96", "97").upper()
    docs = spark.createDataFrame([(1, QUESTION.upper()), (2, QUESTION.title()), (3, "Clean words first. " + plain.upper()), (4, plain.title()),
                                  (5, QUESTION.replace(" ", "\n")), (6, QUESTION.replace(" ", "  ")), (7, numbers),
                                  (8, "CLEAN WORDS ABOUT A FARMER AND A BOAT")], "doc_id long, text string")
    assert pairs(docs, bench) == {(1, 1), (2, 1), (3, 2), (4, 2), (5, 1), (6, 1), (7, 1)}


def test_against_a_plain_version(spark, small_docs):
    from spindle.llm.common import table
    from tests.llm.conftest import SMALL
    bench = table(spark, SMALL, "benchmark")
    want = plain_pairs([(r.doc_id, r.text) for r in small_docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert want and pairs(small_docs, bench) == want
    # The same through a shuffle, for a benchmark too large to broadcast.
    most, T.MAX_BROADCAST = T.MAX_BROADCAST, -1
    try:
        assert pairs(small_docs, bench) == want
    finally:
        T.MAX_BROADCAST = most
    clean = T.decontaminate(small_docs, bench)
    assert clean.columns == small_docs.columns
    assert clean.count() == small_docs.count() - len({d for d, _ in want})


def test_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog"), (None, "word word word word word word")], "item_id long, text string")
    assert pairs(edge_docs, bench) == {(1, 1), (-5, 1), (8, None)}
    assert T.decontaminate(edge_docs, bench).count() == edge_docs.count() - 4
    assert pairs(no_docs, bench) == set()
    assert pairs(edge_docs, bench.limit(0)) == set()
    assert T.decontaminate(edge_docs, bench.limit(0)).count() == edge_docs.count()


def test_no_python_in_the_plan(small_docs, spark):
    plan = T.window_hashes(small_docs.select("doc_id", "text"), 5)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("regexp_extract_all") <= 4       # once in each stage of the plan: not per token
