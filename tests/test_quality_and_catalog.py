import json

from accountweave.operators import catalog, quality
from accountweave.schemas import CRM_COLUMNS
from accountweave.sources.describe import read_describes, read_objects
from accountweave.sources.tables import read_csv, write_csv


def test_orphans_are_counted_per_key(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    assert [tuple(r) for r in quality.orphan_keys(child, "k", parent, "id").collect()] == [("x", 2)]


def test_report_has_every_rule_even_for_empty_tables(spark):
    accounts = spark.createDataFrame([("acc_1",)], "account_id string")
    contacts = spark.createDataFrame([("cnt_1", "acc_1"), ("cnt_2", "acc_9"), ("cnt_3", None)], "contact_id string, account_id string")
    opps = spark.createDataFrame([("opp_1", "acc_1")], "opportunity_id string, account_id string")
    roles = spark.createDataFrame([], "opportunity_id string, contact_id string")
    report = {r.rule: r.orphan_rows for r in quality.integrity_report(contacts, accounts, opps, roles).collect()}
    assert report == {"contact_account": 1, "opportunity_account": 0, "role_opportunity": 0, "role_contact": 0}


def test_object_classes(spark):
    names = {"Order__c": "Custom Object", "Order__change_event": "CDC Event Object", "Order__Share": "System / Security",
             "Order__History": "System / Security", "Account": "Standard Object", "Order__C": "Standard Object"}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r.n: r.c for r in df.select("n", catalog.object_class("n").alias("c")).collect()} == names


def test_describe_files_to_inventory(spark, tmp_path):
    for name, fields in {"Account": ["Id", "Fax"], "User": ["Id"]}.items():
        document = {"name": name, "fields": [{"name": f, "label": f, "type": "string", "nillable": f != "Id", "more": 1} for f in fields]}
        (tmp_path / f"{name}.json").write_text(json.dumps(document, indent=2))
    selected = spark.createDataFrame(
        [("Account", "Id", "Direct"), ("User", "Id", "Direct"), ("User", "UserRole.Name", catalog.RELATIONSHIP), ("Lead", "X.Y", catalog.RELATIONSHIP)],
        "object_name string, field_name string, field_type string",
    )
    inventory = catalog.field_inventory(read_describes(spark, str(tmp_path)), selected)
    rows = {(r.object_name, r.field_name): (r.field_type, r.selection, r.nillable) for r in inventory.collect()}
    assert rows == {
        ("Account", "Id"): ("Direct", "Required", False),
        ("Account", "Fax"): ("Direct", "Optional / Evaluate", True),
        ("User", "Id"): ("Direct", "Required", False),
        ("User", "UserRole.Name"): (catalog.RELATIONSHIP, "Required", True),
    }
    required = inventory.where("selection = 'Required'")
    counts = catalog.count_pivot(required, "object_name", "field_type", [catalog.DIRECT, catalog.RELATIONSHIP], "total_required")
    assert {tuple(r) for r in counts.collect()} == {("Account", 1, 0, 1), ("User", 1, 1, 2)}
    names = catalog.names_per_group(required, "object_name", "field_name")
    assert {tuple(r) for r in names.collect()} == {("Account", "Id", 1), ("User", "Id, UserRole.Name", 2)}

    write_csv(inventory, str(tmp_path / "csv"))
    back = read_csv(spark, str(tmp_path / "csv"), inventory.schema)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, inventory.collect()), key=repr)


def test_required_fields_are_what_is_landed(spark, tmp_path):
    selected = catalog.required_fields(spark)
    rows = {tuple(r) for r in selected.collect()}
    assert len(rows) == sum(map(len, CRM_COLUMNS.values()))
    assert {r for r in rows if r[2] != catalog.DIRECT} == {("User", "UserRole.Name", catalog.RELATIONSHIP)}
    assert ("OpportunityContactRole", "IsPrimary", catalog.DIRECT) in rows
    document = {"fields": [{"name": n, "label": n, "type": "string", "nillable": True} for n in ("Username", "Fax")]}
    (tmp_path / "User.json").write_text(json.dumps(document))
    found = catalog.field_inventory(read_describes(spark, str(tmp_path)), selected).collect()
    assert {(r.field_name, r.label, r.selection) for r in found} == {
        ("Username", "Username", "Required"),
        ("Fax", "Fax", "Optional / Evaluate"),
        ("UserRole.Name", "UserRole.Name (SOQL Relationship Traversal)", "Required"),
    }


def test_global_describe_to_inventory(spark, tmp_path):
    flags = {"queryable": True, "retrieveable": True, "createable": False, "updateable": None, "custom": False}
    objects = [{"name": "Plan__c", "label": "Plan"} | flags | {"custom": True, "x": 1}, {"name": "Plan__History", "label": "Past"} | flags, {"name": "Task"}]
    (tmp_path / "global.json").write_text(json.dumps({"encoding": "UTF-8", "sobjects": objects}, indent=1))
    inventory = catalog.object_inventory(read_objects(spark, str(tmp_path)))
    assert [tuple(r) for r in inventory.orderBy("object_name").collect()] == [
        ("Plan__History", "Past", "System / Security", True, True, False, None, False),
        ("Plan__c", "Plan", "Custom Object", True, True, False, None, True),
        ("Task", None, "Standard Object", None, None, None, None, None),
    ]
    assert [tuple(r) for r in catalog.custom_objects(inventory).collect()] == [("Plan__c", "Plan")]
