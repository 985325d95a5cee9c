"""Task parameters as the reference's JSON gives them."""

from shopflow.functions.strings import flow_pairs
from shopflow.params import TaskParams


def test_from_mapping_unset_and_lists():
    p = TaskParams.from_mapping({
        "startDate": "2018-08-01", "endDate": "2018-08-30", "startAge": 20, "endAge": "50",
        "professionals": "", "cities": " city1 , city2 ", "sex": "", "keywords": ["a", " b"],
        "categoryIds": "1,,2", "targetPageFlow": "1,2,3"})
    assert (p.start_age, p.end_age) == (20, 50)
    assert p.professionals == () and p.sex is None
    assert p.cities == ("city1", "city2") and p.keywords == ("a", "b") and p.category_ids == ("1", "2")
    assert p.target_page_flow == (1, 2, 3)
    assert flow_pairs(p.target_page_flow) == [(0, "1_2"), (1, "2_3")]


def test_from_mapping_defaults():
    p = TaskParams.from_mapping({"startDate": "2024-01-01", "endDate": "2024-01-31"})
    assert p.start_age is None and p.end_age is None and p.keywords == ()
    assert p.target_page_flow == (1, 2, 3, 4, 5, 6, 7)
