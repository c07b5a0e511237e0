"""Rows that every operator has to stand: nulls, empty and very long texts,
repeated rows, ties, further columns with clashing names."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"
PROSE = ("the river bends slowly past seven quiet mills and a bridge of grey stone while two boys on the bank count "
         "barges that carry coal and timber towards the far city under a low white sky and nobody speaks for an hour "
         "because the wind is cold and the evening train has not yet come around the last hill before the station ")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, node long"


def row(doc_id, text, source="s1", lang="en"):
    return doc_id, text, lang, source, None if text is None else len(text), None, 0.5, 7


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [row(1, PROSE), row(2, PROSE), row(3, None), row(4, ""), row(5, "  \n\t "), row(6, "short text"),
            row(7, "x" * 60_000), row(8, PROSE * 60, None), row(1, PROSE), row(None, PROSE + "and then it rains"),
            row(None, None, None, None), row(9, "naïve ▁ sign   日本 \U0001F600 end", "s2"), row(-10, PROSE.upper(), "s2")]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
