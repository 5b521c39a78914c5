"""The stages run one after the other from the command line."""

from papyrine.__main__ import main
from papyrine.operators.hooks import extract_pages
from papyrine.sources.files import list_files
from papyrine.sources.tables import EXTRACTION_SCHEMA, QUALITY_SCHEMA, read_csv, write_stage


def test_all_stages(spark, tmp_path, capsys):
    source = tmp_path / "scrape"
    (source / "deep").mkdir(parents=True)
    pages = []
    for place, name in enumerate(["a.pdf", "deep/a.pdf", "deep/b.PDF", "n.html"]):
        (source / name).write_text("x")
        words = "the and of" if name.endswith("b.PDF") else "yang dan (1) ini"
        pages += [(f"{source}/{name}", number, f"## {words} {place}\n", None) for number in range(3)]
    table = {name: str(tmp_path / name) for name in "pages collated subsets quality moved extraction final csv".split()}
    write_stage(spark.createDataFrame(pages, "pdf_path string, page_no int, text string, error string"), table["pages"])

    main(["collate", str(source), table["pages"], table["collated"]])
    assert sorted(row.name for row in spark.read.parquet(table["collated"]).collect()) == ["a.pdf", "a_1.pdf", "b.PDF"]
    main(["split", table["collated"], table["subsets"], "--size", "2"])
    assert spark.read.parquet(table["subsets"]).groupBy("subset_id").count().count() == 2
    main(["quality", table["pages"], table["quality"]])
    main(["rebase", table["quality"], str(source), "/moved", table["moved"]])
    main(["extract", table["moved"], table["extraction"], "--csv", table["csv"]])
    assert read_csv(spark, table["csv"], EXTRACTION_SCHEMA).count() == 3
    main(["finish", table["extraction"], table["final"], "--base", "/moved/deep/"])
    [row] = spark.read.parquet(table["final"]).collect()
    assert row.pdf_path == "/moved/deep/a.pdf"
    assert row.regex_applied_text == "# yang dan ini 1 yang dan ini 1 yang dan ini 1"  # only the first line loses one #, not two
    assert "'stage': 'finish', 'total_rows': 1" in capsys.readouterr().out
    assert spark.read.parquet(table["moved"]).columns == QUALITY_SCHEMA.names


def test_one_subset_from_listing_to_extraction(spark, tmp_path):
    source = tmp_path / "scrape"
    source.mkdir()
    for number in range(5):
        (source / f"{number}.pdf").write_text("yang dan ini\funtuk itu\fdengan pada")
    table = {name: str(tmp_path / name) for name in "pages collated subsets quality extraction".split()}
    reader = lambda: lambda path: open(path).read().split("\f")  # noqa: E731, SIM115
    write_stage(extract_pages(list_files(spark, f"file://{source}"), reader), table["pages"])
    main(["collate", str(source), table["pages"], table["collated"]])
    assert spark.read.parquet(table["collated"]).count() == 5
    main(["split", table["collated"], table["subsets"], "--size", "2"])
    main(["quality", table["pages"], table["quality"], "--subsets", table["subsets"]])
    main(["extract", table["quality"], table["extraction"], "--subset", "2"])
    assert sorted(row.pdf_path for row in spark.read.parquet(table["extraction"]).collect()) == [f"{source}/2.pdf", f"{source}/3.pdf"]
