"""Benchmark items in another letter case."""

from demandtide.llm import decontaminate as dec

ITEM = "Yesterday Anna bought 12 apples and gave 12 apples to Bert who then sold 5 kg of them at the market in the old town."
GERMAN = "Der Bauer verkauft am Montag seine Milch und den Käse auf dem Markt der Stadt an die Frau vom Amt."
FILLER = "some other words that never occur in any question of the benchmark at all "


def test_copies_in_other_letter_case_are_found(spark):
    new = ITEM.replace("12", "31").replace("Anna", "Carla").replace("Bert", "Dora").replace("5 kg", "9 lb")
    mixed = ITEM.replace("12 apples and", "31 apples and")
    texts = {
        1: FILLER + ITEM.lower(), 2: FILLER + ITEM.upper() + " " + FILLER, 3: ITEM.title(), 4: FILLER + ITEM.lower().replace("12", "31").replace("5 kg", "9 lb"),
        5: GERMAN.lower(), 6: FILLER + GERMAN.upper(), 7: FILLER * 4000 + new.upper().lower() + ".###", 8: "Short One here now", 9: FILLER + mixed.lower(), 10: FILLER + new, 11: FILLER,
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    items = spark.createDataFrame([(10, ITEM), (13, "short One here"), (14, GERMAN), (15, "Yesterday Anna bought")], "item_id long, text string")
    got = {r.doc_id: r.items for r in dec.decontaminate(docs, items).collect()}
    assert got[1] == [10, 15] and got[2] == [10, 15] and got[3] == [10, 15] and got[4] == [10, 15]
    assert got[5] == [14] and got[6] == [14]
    assert got[7] == []  # new names in lower case cannot be told from words: 14 of 21 windows
    assert got[8] == [13]
    assert got[9] == [15] and got[11] == []  # 12 stands for 31 and for 12
    assert 10 in got[10]
    found = {(r.id, r.item_id) for r in dec.contaminated(docs, items, filter_bits=6).collect()}
    assert found == {(k, i) for k, v in got.items() for i in v}


def test_first_word_is_judged_both_ways(spark):
    item = "Rivers flow down to the sea"
    docs = spark.createDataFrame([(1, "we know that Rivers flow down to the sea"), (2, "we know. Rivers flow down to the sea"), (3, "we know that Lakes flow down to the sea")], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.id: r.coverage for r in dec.contaminated(docs, items).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 1.0}
