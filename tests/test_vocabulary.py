from cohortloom.operators import vocabulary, worklist

CONCEPT = "concept_id long, concept_code string, vocabulary_id string, standard_concept string"
LINK = "concept_id_1 long, concept_id_2 long, relationship_id string"


def test_resolution(spark):
    concept = spark.createDataFrame(
        [(5, "a", "X", "S"), (3, "a", "Y", "S"), (9, "b", "ICD", None), (4, "t", "Z", "S"),
         (8, "c", "OTHER", None), (7, "n", "ICD", None), (6, "u", "Z", None)],
        CONCEPT,
    )
    links = spark.createDataFrame(
        [(9, 4, "Maps to"), (8, 4, "Maps to"), (7, 6, "Maps to"), (9, 3, "Is a")], LINK
    )
    codes = spark.createDataFrame([("a",), ("b",), ("c",), ("n",), ("zz",)], "concept_code string")
    found = {r.concept_code: r.concept_id
             for r in vocabulary.resolve_codes(codes, concept, links, ["ICD"]).collect()}
    # duplicate code: lowest id; other vocabulary, non-standard target and unknown code: 0
    assert found == {"a": 3, "b": 4, "c": 0, "n": 0, "zz": 0}
    own = {r.concept_code: r.concept_id
           for r in vocabulary.source_concepts(codes, concept, ["ICD", "X"]).collect()}
    assert own == {"a": 5, "b": 9, "c": 0, "n": 7, "zz": 0}
    both = vocabulary.code_table(codes, concept, links, ["ICD"], ["ICD", "X"])
    assert {tuple(r) for r in both.collect()} == {(c, found[c], own[c]) for c in found}


def test_null_codes_count_as_unmapped(spark):
    facts = spark.createDataFrame([(1, None), (2, "a")], "id int, code string")
    table = spark.createDataFrame([("a", 7)], "concept_code string, concept_id long")
    coded = vocabulary.apply_codes(facts, "code", table, {"code": "concept_id"})
    assert {tuple(r) for r in coded.collect()} == {(1, 0), (2, 7)}
    assert vocabulary.used_codes(facts, "code").count() == 1


def test_worklist(spark):
    drugs = spark.createDataFrame(
        [(0, 0, "x", 1), (0, 9, "x", 1), (5, 0, "y", None), (5, 9, "z", 3), (0, 9, None, 4), (0, 9, None, 4)],
        "drug_concept_id long, drug_type_concept_id long, drug_source_value string, "
        "drug_source_concept_id long",
    )
    notes = spark.createDataFrame([("x", 0)], "note_title string, note_type_concept_id long")
    report = worklist.unmapped_codes({"Drug_Exposure": drugs, "note": notes, "unknown": notes})
    assert {tuple(r) for r in report.collect()} == {
        (0, "x", 1, "Drug_Exposure", "drug_concept_id", 3),
        (0, "y", 0, "Drug_Exposure", "drug_type_concept_id", 1),
        (0, None, 4, "Drug_Exposure", "drug_concept_id", 2),
        (0, "x", 0, "note", "note_type_concept_id", 1),
    }
    assert worklist.by_frequency(report).first().frequency == 3


def test_new_mappings(spark):
    columns = "source_concept_id long, source_code_description string, target_concept_id long"
    reviewed = spark.createDataFrame(
        [(1, "Cough", 5), (1, "COUGH", 4), (2, "Flu", 6), (None, "Ache", 7), (None, "ache", 8)], columns
    )
    stored = spark.createDataFrame([(2, "FLU", 1), (None, "ACHE", 1)], columns)
    new = worklist.new_mappings(reviewed, stored, ["target_concept_id"])
    assert {tuple(r) for r in new.collect()} == {(1, "cough", 4), (None, "ache", 7)}
