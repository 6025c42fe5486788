import datetime as dt
from decimal import Decimal

import pytest

from accountweave.operators.crm import ACCOUNT, CONTACT, LEAD, OPPORTUNITY, OPPORTUNITY_CONTACT_ROLE, SALES_REP, canonical
from accountweave.schemas import CRM_COLUMNS, landed_crm

CREATED, MODIFIED = "2026-01-01T10:00:00Z", "2026-01-02T10:00:00Z"


def landed(spark, object_name, *rows):
    schema = landed_crm(object_name)
    full = [{f: None for f in schema.fieldNames()} | {"CreatedDate": CREATED, "SystemModstamp": MODIFIED} | r for r in rows]
    return spark.createDataFrame([tuple(r[f] for f in schema.fieldNames()) for r in full], schema)


def only(df):
    (row,) = df.collect()
    return row


def test_account(spark):
    row = only(
        canonical(
            ACCOUNT,
            landed(
                spark, "account",
                {"Id": "K-7", "Name": "  Ölmühle & Söhne\t", "Type": "", "Phone": " +49.0 89/77-12 ext 4",
                 "Website": " http://Muehle.example/shop?x=/y ", "Industry": "   ", "AnnualRevenue": 0.005,
                 "NumberOfEmployees": 0, "OwnerId": ""},
            ),
        )
    )
    assert (row.account_id, row.account_name, row.account_type) == ("acc_K-7", "Ölmühle & Söhne\t", "")
    assert (row.phone, row.website, row.industry) == ("+4908977124", "muehle.example", "")
    assert (row.annual_revenue, row.employee_count, row.owner_id) == (Decimal("0.01"), 0, "srep_")
    assert (row.source_system, row.source_record_id) == ("salesforce", "K-7")
    assert row.updated_at - row.created_at == dt.timedelta(days=1)
    assert row.ingested_at and len(row.record_hash) == 64 and len(row) == 15


def test_contact(spark):
    row = only(
        canonical(
            CONTACT,
            landed(spark, "contact", {"Id": "k9", "FirstName": None, "LastName": " van  Dijk", "Email": "\u00c9LAN@Mail.Example",
                                      "Phone": "ext", "Title": " ", "AccountId": "K-7", "OwnerId": "0"}),
        )
    )
    assert (row.contact_id, row.account_id, row.owner_id) == ("cnt_k9", "acc_K-7", "srep_0")
    assert (row.first_name, row.last_name, row.email, row.phone) == (None, "van  Dijk", "\u00e9lan@mail.example", "")
    assert row.job_title == "" and len(row) == 15


def test_lead_defaults_and_links(spark):
    converted = {"Id": "00Q", "IsConverted": True, "ConvertedAccountId": "1", "ConvertedContactId": "2", "ConvertedOpportunityId": "3"}
    rows = {r.lead_id: r for r in canonical(LEAD, landed(spark, "lead", converted, {"Id": "00R"})).collect()}
    row = rows["led_00Q"]
    assert (row.converted_account_id, row.converted_contact_id, row.converted_opportunity_id) == ("acc_1", "cnt_2", "opp_3")
    assert row.is_converted is True and rows["led_00R"].is_converted is False
    assert rows["led_00R"].converted_account_id is None and len(row) == 19


def test_opportunity(spark):
    row = only(
        canonical(
            OPPORTUNITY,
            landed(spark, "opportunity", {"Id": "q", "AccountId": "K-7", "Amount": -0.004, "Probability": 99.999,
                                          "CloseDate": "2024-02-29", "StageName": " Won "}),
        )
    )
    assert (row.amount, row.probability, row.close_date) == (Decimal("0.00"), Decimal("100.00"), dt.date(2024, 2, 29))
    assert (row.is_closed, row.is_won, row.stage) == (False, False, "Won") and len(row) == 18


def test_contact_role(spark):
    row = only(canonical(OPPORTUNITY_CONTACT_ROLE, landed(spark, "opportunity_contact_role", {"Id": "1", "OpportunityId": "6", "Role": " Buyer "})))
    assert (row.opportunity_contact_role_id, row.opportunity_id, row.contact_id) == ("ocr_1", "opp_6", None)
    assert (row.role, row.is_primary) == ("Buyer", False) and len(row) == 11


@pytest.mark.parametrize("role", ["UserRole_Name", "RoleName", "UserRole", None])
def test_rep_takes_the_role_under_any_name(spark, role):
    users = landed(spark, "user", {"Id": "005", "Username": " jo ", "Email": "JO@X.com", "UserRole_Name": "East"})
    if role == "UserRole":
        users = users.selectExpr("* except (UserRole_Name)", "named_struct('Name', UserRole_Name) as UserRole")
    elif role is None:
        users = users.drop("UserRole_Name")
    else:
        users = users.withColumnRenamed("UserRole_Name", role)
    row = only(canonical(SALES_REP, users))
    assert (row.sales_rep_id, row.username, row.email, row.is_active) == ("srep_005", "jo", "jo@x.com", True)
    assert row.role_name == ("East" if role else None) and len(row) == 12


def test_missing_ids_go_and_replayed_copies_collapse(spark):
    rows = [
        {"Id": None, "Name": "no id"},
        {"Id": "1", "Name": "old", "SystemModstamp": "2026-01-01T00:00:00Z"},
        {"Id": "1", "Name": "new", "SystemModstamp": "2026-01-03T00:00:00Z", "_batch_id": "b1"},
        {"Id": "1", "Name": "new", "SystemModstamp": "2026-01-03T00:00:00Z", "_batch_id": "b2"},
    ]
    assert [(r.account_id, r.account_name) for r in canonical(ACCOUNT, landed(spark, "account", *rows)).collect()] == [("acc_1", "new")]


def test_six_objects_are_known():
    assert list(CRM_COLUMNS) == ["account", "contact", "lead", "opportunity", "opportunity_contact_role", "user"]
