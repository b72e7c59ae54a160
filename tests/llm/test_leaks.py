"""Copies of benchmark items that differ in one value, or lie behind other text."""

import pytest

from catloom.llm import decontaminate
from catloom.llm.decontaminate import Windows


def found(item, text):
    return bool(Windows([(1, item)], 8).leaks(text, 13, 8))


LONG = "yesterday Alice took the bus to a small town near the river where her old aunt keeps nine goats behind the barn and later on Alice painted a wooden gate while the rain fell softly over fields of barley until at dusk Alice walked back along the narrow road with 12 apples in a bag and gave 12 away"


@pytest.mark.parametrize("nth", [0, 1, 2])
def test_one_edited_name_hides_no_item(nth):
    at = [i for i, w in enumerate(LONG.split()) if w == "Alice"][nth]
    words = LONG.split()
    words[at] = "Betty"
    assert found(LONG, "some text. " + " ".join(words))


def test_one_edited_number_hides_no_item():
    assert found(LONG, LONG.replace("12 away", "15 away"))
    dense = "the Alice one two three four five Alice six seven eight nine ten Alice red green blue black white Alice and so on until all of it has been said here"
    assert found(dense, dense.replace("Alice red", "Betty red"))


def test_inconsistent_values_do_not_count():
    item = "give 5 a 5 b 5 c 5 d 5 e 5 f 5 g 5 h 5 i 5 j 5 k"
    text = item
    for n in range(10):
        text = text.replace(" 5 ", f" {n + 20} ", 1)
    assert not found(item, text)


@pytest.mark.parametrize("item", ["What is the capital of France?", "Name the largest planet. It has Rings?", "Sum up", "Which of these two rivers is longer, the Nile or the Amazon, and by how much?"])
@pytest.mark.parametrize("before", ["", "please answer ", "Done. ", "see this\n"])
def test_items_are_found_behind_any_text(item, before):
    assert found(item, f"{before}{item} and so on")
    assert found(item, before + item.replace(" ", "\n"))
    if len(item.split()) <= 13:  # others may lack a word
        assert not found(item, before + "Where" + item[item.index(" ") :])


def test_items_of_placeholders_alone():
    assert found("12 + 5 = 17", "we know that 12 + 5 = 17 holds") and found("12 + 5 = 17", "12 + 5 = 17")
    assert not found("12 + 5 = 17", "we know that 12 + 6 = 18 holds") and not found("+ =", "a + = b")


def test_a_slot_still_stands_for_any_name():
    item = "What did Maria say to the 3 men at the gate of the old town before noon?"
    assert found(item, "tell me: " + item.replace("Maria", "Olga").replace("3", "8"))
    assert found(item, "please tell me, What did Olga say to the 8 men at the gate of the old town before noon?")


def test_blocks_count_windows_under_either_code(spark):
    item = " ".join(f"Word{i}. Other{i} goes." for i in range(60))
    made = Windows([(None, item)], 8).n
    assert made > 4 * len(item.split())  # many words may start a sentence or not
    rows = spark.createDataFrame([(i, f"{item} {i}") for i in range(12)], "item_id long, text string")
    held = [b.value for b in decontaminate._blocks(rows, 8, 3 * made, "item_id", "text")]
    assert len(held) >= 4 and sorted(i for b in held for i in b.ids) == list(range(12)) and sum(b.n for b in held) >= 12 * made
    docs = spark.createDataFrame([(7, f"before. {item} 7")], "doc_id long, text string")
    assert {r["item_id"] for r in decontaminate.leaks(docs, rows, block_windows=3 * made).collect()} == set(range(12))
