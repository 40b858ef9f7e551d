"""Landed files, zones, folders and catalog tables."""

import fixtures
import pytest

from tidemark import schemas
from tidemark.operators import quality, unify
from tidemark.plans import reports
from tidemark.sources import catalog, files, images


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    files.land(fixtures.existing_reviews(spark).coalesce(1), root, "text", "existing")
    files.land(fixtures.scraped_reviews(spark).coalesce(1), root, "text", "scraped")
    files.land(fixtures.existing_images(spark).coalesce(1), root, "images", "existing")
    files.land(fixtures.scraped_images(spark).coalesce(1), root, "images", "scraped")
    return root


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_views_end_to_end(spark, lake):
    files.load_existing_data(spark, lake)
    files.load_scraped_data(spark, lake)
    unify.create_unified_views(spark)
    assert spark.table("all_images").count() == 20
    found = reports.reviews_by_source(spark.table("all_reviews")).collect()
    shops = [row[2] for row in [*fixtures.EXISTING, *fixtures.SCRAPED]]
    assert {r.source: r.total_reviews for r in found} == {s: shops.count(s) for s in shops}


def test_quotes_commas_and_line_breaks_survive(spark, lake):
    texts = files.read_reviews(spark, lake).orderBy(files.F.col("review_id").cast("int"))
    assert texts.collect() == fixtures.existing_reviews(spark).collect()


def test_every_text_survives_a_csv_zone(spark, tmp_path):
    texts = ["a\nb", "\r\n", "\x1bn", "\x1b", "\x1be\x1b\n", 'q"\n,', "\\n", "plain", "  x ", None]
    rows = [(str(i), text, "5", "t", "s", "c") for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, schemas.REVIEWS_EXISTING)
    files.land(frame, str(tmp_path), "text", "existing")
    back = files.read_reviews(spark, str(tmp_path)).orderBy("review_id").collect()
    assert [r.review_text for r in back] == texts
    # One line per row and one header per file, so that files can be split anywhere.
    path = files.zone_path(str(tmp_path), "text", "existing")
    parts = len(list((tmp_path / "data/text/existing").glob("part-*")))
    assert files.line_count(spark, path).first().lines == len(texts) + parts


def test_landing_replaces(spark, tmp_path):
    root = str(tmp_path)
    files.land(fixtures.existing_reviews(spark), root, "text", "existing")
    files.land(fixtures.existing_reviews(spark).limit(2), root, "text", "existing")
    assert files.read_reviews(spark, root).count() == 2


def test_wrong_header_fails(spark, tmp_path):
    path = write(tmp_path / "odd.csv", "review_id,rating\n1,5\n")
    with pytest.raises(Exception, match="header|schema"):
        files.read_csv(spark, path, schemas.REVIEWS_EXISTING).collect()


def test_blank_and_short_rows_drop(spark, tmp_path):
    path = write(
        tmp_path / "reviews.csv",
        "Id,ProductId,Score,Summary,Text\n"
        '1,P1,5,good,"all, of ""it"""\n'
        "\n"
        "2,P2\n"
        '4,"P,4,4","4,4"\n'
        "3,P3,4,fine,rest\n"
        '5,P5,4,fine,"last, kept",surplus,more\n',
    )
    complete = files.read_complete_rows(spark, path, schemas.PRODUCT_REVIEWS)
    assert [(r.Id, r.Text) for r in complete.collect()] == [
        ("1", 'all, of "it"'),
        ("3", "rest"),
        ("5", "last, kept"),
    ]
    assert complete.count() == 3
    assert files.preview_reviews(spark, path, 1).count() == 1
    strict = files.read_csv(spark, path, schemas.PRODUCT_REVIEWS, "DROPMALFORMED")
    assert [r.Id for r in strict.collect()] == ["1", "3"]


def test_image_preview(spark, tmp_path):
    lines = "".join(f'{i},"f{i}.jpg",nature,/x/f{i}.jpg,{i}\n' for i in range(60))
    path = write(tmp_path / "listing.csv", "image_id,filename,category,path,size_kb\n" + lines)
    shown = files.preview_images(spark, path)
    assert shown.count() == 49
    assert shown.first().filename == "f0.jpg"


def test_samples(spark):
    reviews = fixtures.existing_reviews(spark)
    assert [r.review_id for r in files.sample_texts(reviews).collect()] == ["1", "2", "3"]
    empty = reviews.where("false")
    assert files.first_sample([empty, reviews], "none", 8).first().sample == "Review 1"
    assert files.first_sample([empty, empty], "none").first().sample == "none"


def test_fallback(spark, tmp_path):
    missing = str(tmp_path / "missing")

    def primary():
        return files.read_csv(spark, missing, schemas.PRODUCT_REVIEWS)

    stand_in = spark.createDataFrame([("1", "P", "4", "s", "t")], schemas.PRODUCT_REVIEWS)
    found = files.read_or_else(primary, lambda: stand_in)
    assert [(r.Id, r.origin) for r in found.collect()] == [("1", "fallback")]
    kept = files.read_or_else(lambda: stand_in, primary)
    assert [r.origin for r in kept.collect()] == ["primary"]


def test_inventory(spark, lake):
    found = {(r.kind, r.origin): (r.files, r.bytes) for r in files.inventory(spark, lake).collect()}
    assert len(found) == 4
    assert found["text", "existing"][0] >= 1
    assert all(size > 0 for _, size in found.values())


def test_line_count(spark, lake):
    path = files.zone_path(lake, "text", "existing")
    assert files.line_count(spark, path).first().lines == 16


def test_summary_has_no_header(spark, lake, tmp_path):
    summary = spark.createDataFrame([("total", "20")], schemas.METRIC_SUMMARY)
    path = str(tmp_path / "summary")
    files.write_csv(summary, path)
    assert [r.value for r in spark.read.text(path).collect()] == ["total,20"]


def test_image_folder(spark, tmp_path):
    folder = tmp_path / "pictures"
    for name, size in (("sea/a.jpg", 1024), ("sea/b.png", 1025), ("city/c.jpg", 1), ("x.txt", 9)):
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(b"\x01" * size)
    listed = images.image_listing(spark, str(folder)).orderBy("path").collect()
    assert [(r.filename, r.category, r.size_kb) for r in listed] == [
        ("c.jpg", "city", "1"),
        ("a.jpg", "sea", "1"),
        ("b.png", "sea", "2"),
    ]
    first = images.image_listing(spark, str(folder), 2).collect()
    # An image has the same id however many are listed.
    assert [r.image_id for r in first] == [r.image_id for r in listed[:2]]
    assert len({r.image_id for r in listed}) == 3
    assert listed[0].asDict().keys() == set(schemas.IMAGE_LISTING.names)

    encoded = images.encode_images(images.read_images(spark, str(folder)), resize=False)
    assert {r.format for r in encoded.collect()} == {"base64"}
    assert quality.files_of_type(spark, str(folder), "*.png").first().asDict() == {
        "files": 1,
        "present": True,
    }
    assert not quality.files_of_type(spark, str(folder), "*.gif").first().present


def test_empty_images_drop(spark):
    frame = spark.createDataFrame([("a", b"\x00\x01"), ("b", b"")], "path string, content binary")
    rows = images.encode_images(frame, resize=False).collect()
    assert [(r.path, r.content) for r in rows] == [("a", "AAE=")]


def test_catalog_tables(spark, lake):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop LOCATION '{lake}/shop.db'")
    catalog.create_tables(spark, lake, "shop")
    catalog.create_tables(spark, lake, "shop")
    shown = catalog.show_tables(spark, "shop").where("NOT isTemporary").collect()
    names = {r.tableName for r in shown}
    assert names == {"reviews", "images", "ia_results"}
    assert spark.table("shop.reviews").agg({"rating": "sum"}).first()[0] == sum(
        int(row[0]) for row in fixtures.EXISTING
    )
    assert spark.table("shop.images").agg({"size_kb": "max"}).first()[0] == max(
        int(row[2]) for row in fixtures.IMAGES
    )
    types = {r.col_name: r.data_type for r in catalog.describe(spark, "shop.images").collect()}
    assert (types["width"], types["filename"]) == ("int", "string")
    spark.sql("INSERT INTO shop.ia_results VALUES ('1', 'text', '{}', 0.5D, 'now')")
    assert spark.table("shop.ia_results").count() == 1
    described = catalog.compute_statistics(spark, "shop.reviews").collect()
    assert any("15 rows" in (r.data_type or "") for r in described)
    extended = catalog.show_extended(spark, "shop", "reviews").first()
    assert "Provider: csv" in extended.information


def test_checks(spark, lake, tmp_path):
    path = files.zone_path(lake, "text", "existing")
    assert quality.header_has(spark, path, "review_text")
    assert not quality.header_has(spark, path, "Score")
    reviews = files.read_reviews(spark, lake)
    assert quality.missing_columns(reviews, ["rating", "Score"]) == ["Score"]
    assert quality.write_and_verify(reviews, str(tmp_path / "copy")) == (15, 15)
