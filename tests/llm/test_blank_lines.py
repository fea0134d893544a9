"""Blank lines between paragraphs do not exempt a passage from comparison."""

import pytest

from barloom.llm import line_chunks

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("gap", ["\n\n", "\n \t\n\n"])
def test_copy_with_blank_lines_goes_whole(spark, gap):
    text = gap.join(f"paragraph number {i} of a copied text" for i in range(200))
    docs = spark.createDataFrame([(1, text), (2, text)], SCHEMA)
    got = {r.doc_id: r for r in line_chunks.op3_line_chunks(docs).collect()}
    assert got[1].n_removed_lines == 0
    assert got[2].n_removed_lines == got[2].n_lines == len(text.split("\n"))
    assert [r.text for r in line_chunks.remove_repeats(docs).collect()] == [text]


def test_every_chunk_has_visible_lines():
    for tail in ([], [""], ["", "end"], ["", "end", ""]):
        lines = [x for i in range(300) for x in (f"paragraph {i}", "")] + tail
        chunks = line_chunks.cut(lines)
        assert sum(n for _, n in chunks) == len(lines)
        assert all(sum(1 for x in lines[a:a + n] if x.strip()) >= 2 for a, n in chunks)
    assert line_chunks.cut(["one", "", ""]) == [(0, 3)]
