import random

from pyspark.sql import functions as F

from weirflow.llm import lines, neardup

COLUMNS = "doc_id bigint, source string, text string, host string, n bigint"


def test_lines_of_many_pages_of_a_host_go(spark):
    rows = [(i, "a", f" Home\nown {i}\n\nHome \r" if i < 10 else f"own {i}", "x", 1) for i in range(40)]
    rows += [(100 + i, "b", "Home\nfew pages", "x", 1) for i in range(5)]
    rows += [(200, None, None, None, None), (201, "a", "", None, None)]
    rows += [(300 + i, "a", "a copied page\nin many copies", "x", 1) for i in range(30)]
    frame = spark.createDataFrame(rows, COLUMNS)
    got = {r.doc_id: r for r in lines.drop_boilerplate(frame).collect()}
    assert len(got) == len(rows)
    assert got[0].text == "own 0\n" and got[0].n_lines == 4 and got[0].n_dropped == 2
    assert got[30].text == "own 30" and got[30].n_dropped == 0
    assert got[100].text == "Home\nfew pages"  # too few pages to tell
    assert got[200].text is None and got[200].n_lines == 0
    assert got[201].text == ""
    assert got[300].text == "a copied page\nin many copies"  # copies are one page
    assert got[0].host == "x" and got[0].n == 1


def test_null_hosts_are_one_host_and_long_texts_pass(spark):
    long = "\n".join(f"line {i}" for i in range(50_000))
    rows = [(i, None, f"menu\n{i}" if i else "menu\n" + long, None, None) for i in range(30)]
    got = {r.doc_id: r.text for r in lines.drop_boilerplate(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert got[0] == long and got[7] == "7"


def test_empty_table(spark):
    frame = spark.createDataFrame([], COLUMNS)
    assert lines.drop_boilerplate(frame).count() == 0
    assert lines.drop_boilerplate(frame, counts=False).columns == frame.columns


def test_repeated_rows_all_stay(spark):
    frame = spark.createDataFrame([(1, "a", "same\ntext", "x", 1)] * 6, COLUMNS)
    assert lines.drop_boilerplate(frame).where(F.col("text") == "same\ntext").count() == 6


def prose(draw, words):
    return " ".join("".join(draw.choices("abcdefghij", k=5)) for _ in range(words))


def near_copies(draw, copies, others, menu=False):
    """Copies of one page of 40 lines, each with one line edited, among other pages."""
    page = [prose(draw, 8) for _ in range(40)]
    rows = []
    for i in range(copies):
        own = list(page)
        own[draw.randrange(40)] = prose(draw, 8)
        rows.append(own)
    rows += [[prose(draw, 8) for _ in range(40)] for _ in range(others)]
    return page, [(i, "a", "\n".join((["Home"] if menu else []) + r), "x", i) for i, r in enumerate(rows)]


def test_near_copies_keep_their_text(spark):
    _, rows = near_copies(random.Random(1), 30, 10)
    frame = spark.createDataFrame(rows, COLUMNS)
    clean = lines.drop_boilerplate(frame, counts=False)
    assert {r.doc_id: r.text for r in clean.collect()} == {i: t for i, _, t, _, _ in rows}
    left = neardup.keep_one(clean).collect()
    assert len(left) == 11 and sorted(len(r.text.split("\n")) for r in left) == [40] * 11


def test_a_menu_goes_from_near_copies_and_others_alike(spark):
    draw = random.Random(2)
    _, rows = near_copies(draw, 30, 30, menu=True)
    clean = lines.drop_boilerplate(spark.createDataFrame(rows, COLUMNS), counts=False)
    assert {r.doc_id: r.text for r in clean.collect()} == {i: t.removeprefix("Home\n") for i, _, t, _, _ in rows}


def test_a_menu_of_half_a_page_goes(spark):
    draw = random.Random(3)
    menu = "\n".join(prose(draw, 4) for _ in range(10))
    rows = [(i, "a", (menu + "\n" if i < 30 else "") + prose(draw, 40), "x", i) for i in range(60)]
    clean = lines.drop_boilerplate(spark.createDataFrame(rows, COLUMNS), counts=False)
    assert not any("\n" in r.text for r in clean.collect())


def test_any_names_of_columns(spark):
    names = ["row", "host", "body", "found", "kept", "of_host", "_ld_host", "_rid", "_t1", "n_lines", "n_dropped", "lines"]
    rows = [(i, "a", f"Home\nown text number {i}", *[f"{n}{i}" for n in names]) for i in range(30)]
    rows += [(None, None, None, *[None] * len(names)), rows[3]]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string" + "".join(f", `{n}` string" for n in names))
    got = lines.drop_boilerplate(frame)
    assert got.columns == [*frame.columns, "n_lines_", "n_dropped_"]
    clean = [(*r[:2], r[2] and r[2].removeprefix("Home\n"), *r[3:]) for r in rows]
    assert sorted(map(repr, (tuple(r)[:-2] for r in got.collect()))) == sorted(map(repr, clean))
    one = neardup.keep_one(frame)
    assert one.columns == frame.columns
    assert sorted(map(repr, map(tuple, one.collect()))) == sorted(map(repr, rows[:-1]))
