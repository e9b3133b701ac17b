"""The published lists match each row's own whole text, in the query and in its SQL, whatever the row's id."""

import duckdb

import __spark_entry__ as ent

LONG = "lorem ipsum " * 2000
PLAIN = [LONG, "", None]


def hidden(words):
    """Each word in capitals inside another one, at the end of a long text."""
    return [f"{LONG}x{w.upper()}y" for w in words.split()]


def rows_of(texts):
    """Every text once under each remainder of the ids by 5."""
    return [(i, texts[i // 5]) for i in range(5 * len(texts))]


def ids_of(texts, all_texts):
    return [i for i, t in rows_of(all_texts) if t in texts]


def run(spark, folder, key, texts):
    """The rows of the query, sorted, after a comparison with those of its SQL."""
    path = f"{folder}/documents.parquet"
    spark.createDataFrame(rows_of(texts), "doc_id long, text string").write.parquet(path)
    got = sorted(tuple(r) for r in ent.queries()[key](spark, str(folder)).collect())
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{path}/*.parquet')")
    assert got == sorted(con.execute(ent.oracle_sql()[key]).fetchall())
    return got


def test_flt5_every_word_in_whole_texts(spark, tmp_path):
    food = hidden("restaurant food pizza burger cafe coffee sushi bar bakery diner grill bistro thai mexican italian chinese")
    texts = food + hidden("sandwich korean") + PLAIN
    assert [i for i, in run(spark, tmp_path, "flt5_published_keywords", texts)] == ids_of(food, texts)


def test_flt6_every_word_in_whole_texts(spark, tmp_path):
    food = hidden("restaurant food pizza burger cafe sushi thai mexican italian chinese bakery diner bar grill bistro")
    texts = food + hidden("coffee sandwich korean") + PLAIN
    assert [i for i, in run(spark, tmp_path, "flt6_published_keywords", texts)] == ids_of(food, texts)


def test_cnd1_every_arm_in_whole_texts(spark, tmp_path):
    arms = {"pizza": "Pizza", "sushi": "Sushi", "thai": "Thai", "mexican": "Mexican", "italian": "Italian", "chinese": "Chinese",
            "burger": "Burgers", "sandwich": "Sandwiches", "coffee": "Coffee & Tea", "cafe": "Coffee & Tea", "bakery": "Bakery",
            "diner": "American (Traditional)", "american": "American (New)", "seafood": "Seafood", "indian": "Indian", "korean": "Korean",
            "vietnamese": "Vietnamese", "mediterranean": "Mediterranean", "bar": "Other", "food": "Other", "restaurant": "Other"}
    label = dict(zip(hidden(" ".join(arms)), arms.values())) | dict.fromkeys(PLAIN, "Other")
    label |= {f"Food {LONG} bars": "Bars & Grills", f"Thai {LONG} sushi": "Sushi", f"Seafood {LONG} bars": "Bars & Grills"}
    assert run(spark, tmp_path, "cnd1_published_taxonomy", list(label)) == [(i, label[t]) for i, t in rows_of(list(label))]


def test_cnd2_every_arm_in_whole_texts(spark, tmp_path):
    arms = {"pizza": "Pizza", "sushi": "Sushi", "thai": "Thai", "mexican": "Mexican", "italian": "Italian", "chinese": "Chinese",
            "burger": "Burgers", "coffee": "Coffee & Tea", "cafe": "Coffee & Tea", "bakery": "Bakery", "american": "American (New)",
            "seafood": "Seafood"}
    label = dict(zip(hidden(" ".join(arms)), arms.values())) | {f"Thai {LONG} sushi": "Sushi"}
    label |= {t: t for t in hidden("sandwich diner korean bar food") + PLAIN}
    assert run(spark, tmp_path, "cnd2_published_dev_taxonomy", list(label)) == [(i, label[t]) for i, t in rows_of(list(label))]
