"""The registered corpus queries: which are compared with DuckDB, and which test stands for each of the others."""

import os

import pytest

import __spark_entry__
from checks.compare import difference, duck
from creditloom.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"

#: Query without SQL -> file and test that compares it, or its operator, with a brute-force version, a round trip or held-out rows.
STANDS_FOR = {
    "op1_simhash": "test_operators.py::test_simhash_links_are_those_of_all_pairs",
    "op2_toxicity": "test_operators.py::test_toxicity_on_documents_kept_out",
    "op3_secrets": "test_operators.py::test_secret_patterns_and_network",
    "op4_packing": "test_operators.py::test_packing_holds_every_id_once",
    "op5_substring_dedup": "test_operators.py::test_substring_dedup_against_brute_force",
    "op6_personal_data": "test_operators.py::test_personal_data_patterns_and_field",
    "op8_token_output": "test_operators.py::test_token_files_give_back_the_ids",
    "op9_neighbours": "test_operators.py::test_neighbours_recall_ties_and_unusable_vectors",
    "op11_spelling": "test_spelling.py::test_against_brute_force",
    "op12_suffix_dedup": "test_suffix_dedup.py::test_against_brute_force",
    "op13_hard_negatives": "test_hard_negatives.py::test_against_brute_force",
}


def test_every_query_is_compared_with_something():
    assert set(STANDS_FOR) | set(oracle_sql()) == set(queries())
    here = os.path.dirname(os.path.abspath(__file__))
    for where in STANDS_FOR.values():
        name, test = where.split("::")
        with open(f"{here}/{name}") as file:
            assert f"def {test}(" in file.read(), where


def test_all_are_registered():
    assert {*queries(), "pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, name):
    assert difference(queries()[name](spark, SF), duck(SF).sql(oracle_sql()[name])) is None
