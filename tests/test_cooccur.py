import json
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from weftwork.operators.cooccur import (
    IdentifierEntity,
    PairLink,
    identifier_entities,
    mapped_pairs,
    pair_links,
    parse_identifiers,
)

LINKS = [
    PairLink("phone", "mail", "std", "phone_mail", "phone_number", "mail_box"),
    PairLink("mac", "mac", "std", "mac_mac", "mac_address", "mac_address"),
    PairLink("mail", "imei", "std", "mail_imei", "mail_box", "imei"),
    PairLink("imei", "mail", "std", "imei_mail", "imei", "mail_box"),
]


def lines(spark, *arrays):
    return spark.createDataFrame([(a if isinstance(a, str) else json.dumps(a),) for a in arrays], "value string")


def member(id_type, id_):
    return {"id_type": id_type, "id": id_}


def test_two_members_give_two_entities_and_one_link(spark):
    records = parse_identifiers(lines(spark, [member("phone", "1234"), member("mail", "1234@sina.com")]))
    types = [IdentifierEntity("phone", "std", "phone_number", "phone"), IdentifierEntity("mail", "std", "mail_box", "mail")]
    assert sorted(r["id"] for r in identifier_entities(records, types, "r").collect()) == [
        "r@mail~`#1234@sina.com", "r@phone~`#1234",
    ]
    (link,) = pair_links(records, LINKS, "r").collect()
    assert link["id"] == link["relation_id"] == "r@1234@sina.com~`#1234"
    # the end types follow the order in the array: the first member is the source
    assert (link["from_entity_type"], link["from_entity_id"]) == ("mail_box", "mail_box~`#1234@sina.com")
    assert (link["to_entity_type"], link["to_entity_id"]) == ("phone_number", "phone_number~`#1234")
    assert link["direction_type"] == "1"
    assert link["fields"] == {"phone_mail_phoneid": "1234", "phone_mail_mailid": "1234@sina.com"}


def test_members_are_filtered_and_cleaned(spark):
    parsed = parse_identifiers(
        lines(
            spark,
            [member("mac", "a:b:c"), member("car", "1"), member("phone", None), {"id_type": None, "id": "2"}, member("imsi", 5)],
            [],
            [member("car", "1")],
            "no json",
        )
    )
    assert [[tuple(m) for m in r["members"]] for r in parsed.collect()] == [[("mac", "abc"), ("imsi", "5")]]


def test_a_pair_is_found_in_either_order_and_blank_ids_are_not(spark):
    records = parse_identifiers(
        lines(spark, [member("mail", "m"), member("phone", "p")], [member("imei", "i"), member("mail", "m")],
              [member("mail", " "), member("phone", "p")], [member("mac", "1"), member("mac", "2")])
    )
    found = {r["relation_type"]: r for r in pair_links(records, LINKS, "r").collect()}
    assert sorted(found) == ["imei_mail", "mac_mac", "phone_mail"]
    assert found["mac_mac"]["fields"] == {"mac_mac_macid": "2"}


@pytest.mark.parametrize("block", [1, 2, 3, 5, 128])
def test_long_arrays_lose_no_pair(spark, block):
    arrays = [[member("phone" if i % 3 else "mail", f"{n}-{i}") for i in range(n)] for n in (1, 2, 5, 6, 7, 13)]
    arrays.append(arrays[-1])
    expected = Counter(
        (a["id"], b["id"]) for array in arrays for a, b in combinations(array, 2) if a["id_type"] != b["id_type"]
    )
    pairs = mapped_pairs(parse_identifiers(lines(spark, *arrays)), LINKS, block)
    assert Counter((r["a"]["id"], r["b"]["id"]) for r in pairs.collect()) == expected


def test_all_pairs_of_one_type(spark):
    n = 300
    records = parse_identifiers(lines(spark, [member("mac", str(i)) for i in range(n)]))
    pairs = mapped_pairs(records, LINKS)
    assert pairs.count() == n * (n - 1) // 2
    assert pairs.select(F.col("a.id"), F.col("b.id")).distinct().count() == n * (n - 1) // 2
