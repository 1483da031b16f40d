import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks.inputs import workbook
from compare import rows
from strataline import fixed_values as fixed
from strataline.functions.values import snake_case
from strataline.operators.quality import clean_rows, is_empty, quarantine, row_count, split_keyless
from strataline.sources import tables
from strataline.sources.files import (
    read_csv,
    read_json_documents,
    read_json_elements,
    read_json_lines,
    stamp,
)
from strataline.sources.workbook import read_workbooks

HEADER = "id,kind,sort,title,where,cost\n"
PRODUCTS = HEADER + (
    'P-1,Furniture,Tables,"Desk, oak",Ohio,120.5\n'
    "P-2,Technology,Phones,Phone; black,Utah,99.0\n"
    "P-3,Office,Paper,Sheets,Iowa,4.25\n"
    "P-4,Office,Labels,Stickers,Maine,3.5,extra\n"
    ",Office,Labels,Stickers,Maine,3.5,extra\n"
)


def order(number, **changes):
    made = {
        "Row ID": number,
        "Order ID": f"O-{number}",
        "Order Date": "3/11/2016",
        "Ship Date": "9/11/2016",
        "Ship Mode": "Standard",
        "Customer ID": "C-1",
        "Product ID": "P-1",
        "Quantity": 2,
        "Price": 10.5,
        "Discount": 0,
        "Profit": 3.25,
    }
    return {**made, **changes}


def written(spark, frame, tmp_path):
    frame.write.parquet(str(tmp_path / "written"))
    return spark.read.parquet(str(tmp_path / "written"))


def test_csv_keeps_malformed_rows_with_their_text(spark, landing, tmp_path):
    raw = read_csv(spark, [landing("p.csv", PRODUCTS)])
    all_rows = written(spark, raw, tmp_path)
    assert row_count(all_rows).first().n_rows == 5
    assert clean_rows(all_rows).count() == 3
    bad = rows(quarantine(all_rows))
    assert bad[0] == (
        "P-4", "Office", "Labels", "Stickers", "Maine", 3.5,
        "P-4,Office,Labels,Stickers,Maine,3.5,extra",
    )
    assert bad[1][0] is None and len(bad) == 2


def test_csv_missing_token_and_bad_number_are_malformed(spark, landing, tmp_path):
    text = HEADER + "P-1,A,B,C,D\nP-2,A,B,C,D,cheap\nP-3,A,B,C,D,1.0\n"
    all_rows = written(spark, read_csv(spark, [landing("p.csv", text)]), tmp_path)
    assert [r.product_id for r in clean_rows(all_rows).collect()] == ["P-3"]
    assert sorted(r.product_id for r in quarantine(all_rows).collect()) == ["P-1", "P-2"]


def test_csv_schema_is_nullable_but_for_the_load_time(spark, landing):
    frame = stamp(read_csv(spark, [landing("p.csv", PRODUCTS)]))
    expected = StructType.fromDDL(fixed.PRODUCT_FEED + ", load_ts timestamp not null")
    assert frame.schema == expected


def test_json_document_and_its_normalised_schema(spark, landing):
    path = landing("o.json", json.dumps([order(1), order(2, **{"Discount": 0.5})]))
    frame = stamp(read_json_documents(spark, [path]))
    assert frame.count() == 2
    assert frame.schema == StructType.fromDDL(fixed.ORDER_FEED + ", load_ts timestamp not null")
    snake = snake_case(frame)
    bronze = StructType.fromDDL(fixed.BRONZE_ORDERS)
    assert snake.columns == bronze.fieldNames()
    assert [f.dataType for f in snake.schema] == [f.dataType for f in bronze]


def test_a_syntax_error_makes_one_row_of_a_document(spark, landing):
    text = json.dumps([order(1), order(2)], indent=1).replace('"Profit"', '"Profit', 1)
    frame = read_json_documents(spark, [landing("bad.json", text)])
    assert frame.count() == 1
    assert len(frame.where(F.col(fixed.CORRUPT).isNotNull()).collect()) == 1


def test_a_type_error_flags_the_rows_of_its_document_only(spark, landing, tmp_path):
    good = landing("a.json", json.dumps([order(1)]))
    bad = landing("b.json", json.dumps([order(2), order(3, **{"Quantity": "two"})]))
    all_rows = written(spark, read_json_documents(spark, [good, bad]), tmp_path)
    assert [r["Row ID"] for r in clean_rows(all_rows).collect()] == [1]


def test_elements_of_well_formed_documents_are_read_alike(spark, landing, tmp_path):
    odd = order(3, **{"Order ID": 7, "Ship Mode": None, "Customer ID": 'é "q" \\ \n', "Price": 5, "Profit": 1e-7, "More": [1]})
    del odd["Product ID"]
    paths = [
        landing("a.json", json.dumps([order(1), odd], indent=2)),
        landing("b.json", json.dumps(order(4, **{"Ship Mode": {"by": ["sea", None]}, "Profit": -12345678.25}), separators=(",", ":"))),
        landing("c.json", "[]"),
        landing("d.json", json.dumps([order(n) for n in range(5, 400)])),
    ]
    frame = read_json_elements(spark, paths)
    assert frame.schema == StructType.fromDDL(fixed.ORDER_FEED)
    assert rows(frame) == rows(read_json_documents(spark, paths))
    assert is_empty(quarantine(written(spark, frame, tmp_path)))


ELEMENTS = [
    (order(1), True),
    (order(2, **{"Quantity": "two"}), False),
    (order(3, **{"Quantity": 1.5}), False),
    (order(4, **{"Row ID": 12345678901234567890}), False),
    (order(5, **{"Price": "5"}), False),
    (order(6, **{"Price": True}), False),
    (order(7, **{"Price": {}}), False),
    (7, False),
    (None, False),
    ([order(8)], False),
    (order(9, **{"Price": None}), True),
    ({}, True),
]


def test_a_type_error_costs_its_own_element_only(spark, landing, tmp_path):
    path = landing("a.json", json.dumps([element for element, _ in ELEMENTS]))
    all_rows = written(spark, read_json_elements(spark, [path]), tmp_path)
    clean = [r["Row ID"] for r in clean_rows(all_rows).collect()]
    assert sorted(clean, key=repr) == [1, 9, None]
    texts = [json.loads(r[fixed.CORRUPT]) for r in quarantine(all_rows).collect()]
    bad = [element for element, good in ELEMENTS if not good]
    assert sorted(texts, key=repr) == sorted((dict(sorted(b.items())) if isinstance(b, dict) else b for b in bad), key=repr)
    # What is right in an element stays, as with lines.
    assert {r["Order ID"] for r in quarantine(all_rows).collect()} == {f"O-{n}" for n in range(2, 8)} | {None}


def test_broken_blank_and_repeating_documents(spark, landing, tmp_path):
    texts = {"broken": '[{"Row ID": 1},,]', "repeats": '[{"Row ID": 1, "Row ID": 2}]', "text": '"x"', "null": "null"}
    paths = [landing(f"{name}.json", text) for name, text in texts.items()]
    paths += [landing("blank.json", " \n"), landing("empty.json", ""), landing("good.json", json.dumps(order(1)))]
    all_rows = written(spark, read_json_elements(spark, paths), tmp_path)
    assert [r["Row ID"] for r in clean_rows(all_rows).collect()] == [1]
    assert sorted(r[fixed.CORRUPT] for r in quarantine(all_rows).collect()) == sorted(texts.values())


def test_large_documents_go_through_the_other_reader(spark, landing, monkeypatch):
    from strataline.sources import files

    paths = [landing("a.json", json.dumps([order(n) for n in range(50)])), landing("b.json", json.dumps([order(99)]))]
    monkeypatch.setattr(files, "ELEMENT_DOCUMENT_BYTES", 1000)
    assert rows(read_json_elements(spark, paths)) == rows(read_json_documents(spark, paths))
    assert read_json_elements(spark, paths).count() == 51


def test_json_lines_isolate_each_error(spark, landing, tmp_path):
    lines = [json.dumps(order(1)), '{"Row ID": 2,', json.dumps(order(3, **{"Quantity": "two"}))]
    all_rows = written(spark, read_json_lines(spark, landing("o.json", "\n".join(lines))), tmp_path)
    assert [r["Row ID"] for r in clean_rows(all_rows).collect()] == [1]
    assert quarantine(all_rows).count() == 2


def test_several_paths_and_none(spark, landing):
    paths = [landing(f"{i}.csv", HEADER + f"P-{i},A,B,C,D,1.0\n") for i in range(3)]
    assert sorted(r.product_id for r in read_csv(spark, paths).collect()) == ["P-0", "P-1", "P-2"]
    assert is_empty(read_csv(spark, []))
    assert not is_empty(read_csv(spark, paths[:1]))


def test_a_stream_needs_one_folder(spark, landing):
    landing("p.csv", PRODUCTS)
    assert read_csv(spark, landing.folder, stream=True).isStreaming
    with pytest.raises(ValueError):
        read_csv(spark, [landing.folder], stream=True)


def test_load_time_can_be_given(spark):
    moment = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
    frame = stamp(spark.range(2), moment).select(F.col("load_ts").cast("bigint"))
    assert rows(frame) == [(int(moment.timestamp()),)] * 2


def test_rows_without_a_key_are_split_off(spark):
    frame = spark.createDataFrame([("a", 1), (None, 2), ("c", None)], "k string, n int")
    keyed, keyless = split_keyless(frame, ["k", "n"])
    assert rows(keyed) == [("a", 1)]
    assert keyless.count() == 2


FIELDS = [line.split()[0] for line in fixed.CUSTOMER_FEED.strip().splitlines()][:-1]


def customer(number, **changes):
    return [changes.get(f, f"{f} {number}") for f in FIELDS]


def test_workbooks_inline_and_shared_text_and_empty_cells(spark, landing):
    header = [f.title() for f in FIELDS]
    landing("a.xlsx", workbook(header, [customer(1), customer(2, phone=None, region=None)]))
    landing("b.xlsx", workbook(header, [customer(3, email="<a&b>")], shared=True))
    landing("c.xlsx", workbook(header, []))
    landing("notes.txt", "not a workbook")
    frame = read_workbooks(spark, landing.folder)
    assert frame.columns == [*FIELDS, fixed.CORRUPT]
    assert frame.where(F.col(fixed.CORRUPT).isNotNull()).isEmpty()
    got = {r.customer_id: r for r in frame.collect()}
    assert sorted(got) == ["customer_id 1", "customer_id 2", "customer_id 3"]
    assert got["customer_id 2"].phone is None and got["customer_id 2"].region is None
    assert got["customer_id 3"].email == "<a&b>"


def test_a_bad_workbook_and_a_row_too_wide_cost_no_others(spark, landing):
    landing("good.xlsx", workbook(FIELDS, [customer(1), [*customer(2), "left over"]]))
    landing("~$good.xlsx", b"locked by someone")
    content = workbook(FIELDS, [customer(3)])
    landing("cut.xlsx", content[: len(content) // 2])
    found = read_workbooks(spark, landing.folder).collect()
    good = [r for r in found if r[fixed.CORRUPT] is None]
    assert [r.customer_id for r in good] == ["customer_id 1"]
    reasons = sorted(r[fixed.CORRUPT] for r in found if r[fixed.CORRUPT])
    assert len(reasons) == 3 and sum("BadZipFile" in reason for reason in reasons) == 2
    assert any("row 3 has 1 cells too many" in reason for reason in reasons)


def test_workbook_rows_beyond_one_chunk(spark, landing):
    landing("a.xlsx", workbook(FIELDS, [customer(i) for i in range(25_000)], shared=True))
    frame = read_workbooks(spark, landing.folder)
    assert frame.select("customer_id").distinct().count() == 25_000


def test_append_matches_names_and_refuses_others(spark, lake):
    name = f"{lake.schemas[0]}.pairs"
    tables.create_table(spark, name, "a int, b string", f"{lake.root}/pairs")
    tables.append(spark.createDataFrame([("x", 1)], "b string, a int"), name)
    assert rows(spark.table(name)) == [(1, "x")]
    with pytest.raises(ValueError):
        tables.append(spark.createDataFrame([("x", 1, 2)], "b string, a int, c int"), name)
    tables.overwrite(spark.createDataFrame([(2, "y")], "a int, b string"), name)
    assert rows(spark.table(name)) == [(2, "y")]


def test_replacing_partitions_leaves_others_alone(spark, lake):
    name = f"{lake.schemas[0]}.parts"
    tables.create_table(spark, name, "v int, p string", f"{lake.root}/parts", ["p"])
    for batch in ("a", "b", "b", "a"):
        tables.replace_partitions(spark.createDataFrame([(1, batch)], "v int, p string"), name)
    assert rows(spark.table(name)) == [(1, "a"), (1, "b")]
    with pytest.raises(ValueError):
        tables.overwrite(spark.table(name), name)


def test_one_partition_can_be_cleared(spark, lake):
    name = f"{lake.schemas[0]}.numbered"
    tables.create_table(spark, name, "v int, p int", f"{lake.root}/numbered", ["p"])
    tables.replace_partitions(spark.createDataFrame([(1, 1), (2, 2)], "v int, p int"), name)
    tables.clear_partition(spark, name, "p", 1)
    assert rows(spark.table(name)) == [(2, 2)]
