import pytest

from tesserae import cli


def test_commands(spark, tmp_path):
    at = lambda *x: str(tmp_path.joinpath(*x))
    rows = lambda data, schema, path: spark.createDataFrame(data, schema).write.parquet(path)
    rows([(1, 0, "A"), (2, 0, "B"), (3, 14, "Frau"), (4, 0, "C")], "page_id long, page_namespace int, page_title string", at("w", "page"))
    rows([(1, 0, "B")], "rd_from long, rd_namespace int, rd_title string", at("w", "redirect"))
    rows([(2, "Frau")], "cl_from long, cl_to string", at("w", "categorylinks"))
    rows([(1, "wikibase_item", "Q1"), (2, "wikibase_item", "Q2")], "pp_page long, pp_propname string, pp_value string", at("w", "page_props"))
    person = "person string, label string, sitelink string, dateofbirth string, gndid string"
    place = "location string, label string, sitelink string, coords string, gndid string"
    group = "organisation string, label string, sitelink string, inception string, gndid string"
    for name, schema, data in (("subject", person, [("e/Q2", "B", "s/B", "1900-01-01T00:00:00Z", None)]), ("fictional-character", person, []), ("fictional-person", person, []), ("geographic-entity", place, [("e/Q9", "X", "s/X", "Point(1 22)", None)]), ("fictional-location", place, [])):
        rows(data, schema, at("x", f"de-{name}"))
    for name in ("armed-organization", "association", "business", "fictional-organisation", "group-of-people", "institution", "organ"):
        rows([], group, at("x", f"de-{name}"))
    rows([("e/Q5",)], "woa string", at("x", "de-work-of-arts"))
    cli.main(["join-entities", at("x"), "de", "s/", at("ent")], spark)
    ent = {r["page_title"]: r for r in spark.read.parquet(at("ent")).collect()}
    assert ent["B"]["ent_type"] == "PER" and ent["B"]["dateofbirth"].year == 1900 and ent["X"]["latitude"] == "2"

    cli.main(["redirects", at("ent"), at("w"), at("red")], spark)
    assert spark.read.parquet(at("red")).collect()[0]["rd_from_title"] == "A"
    cli.main(["redirects-to-entities", at("w"), at("ent"), at("res")], spark)
    assert {r[0] for r in spark.read.parquet(at("res")).collect()} == {"B", "X"}
    rows([(1, "A", "Hier [[B]]."), (3, "K", "x")], "page_id long, title string, text string", at("text"))
    cli.main(["tag-entities", at("text"), at("ent"), at("w"), at("tagged")], spark)
    assert [r["tags"] for r in spark.read.parquet(at("tagged")).collect()] == ['[["O","B-PER","O"]]']
    rows([("B",), ("B",), ("Z",)], "target string", at("links"))
    cli.main(["apriori-probs", at("ent"), at("links")], spark)
    assert {r["page_title"]: round(r["proba"], 3) for r in spark.read.parquet(at("ent")).collect()} == {"B": 0.667, "X": 0.0}
    cli.main(["train-test-split", at("w"), "0.4", "0.3", "0.3", at("tr"), at("de"), at("te")], spark)
    assert spark.read.parquet(at("tr")).count() == 1
    cli.main(["extract-typed", at("w"), at("typed")], spark)
    assert [tuple(r) for r in spark.read.parquet(at("typed")).collect()] == [("B", "PER")]
    cli.main(["map-languages", at("map"), "DE|FR", at("typed"), at("w"), at("w")], spark)
    assert [tuple(r) for r in spark.read.parquet(at("map", "fr-entities")).collect()] == [("B", "PER")]
    with pytest.raises(SystemExit):
        cli.main(["nothing"], spark)
