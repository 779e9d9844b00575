import pytest

from cardlens import params


def test_accepts_numbers_and_text():
    assert params.parse_zip("07501") == params.parse_zip(7501) == 7501
    assert params.parse_month(2018, 2) == params.parse_month("2018", "02") == "201802"
    assert params.parse_date_bound(20180214) == "20180214"
    assert params.parse_date_bound("201805") == "201805"
    assert params.parse_ssn(" 123456100 ") == 123456100
    assert params.parse_card(" 4210 ") == "4210"


@pytest.mark.parametrize("call", [
    lambda: params.parse_zip("abc"),
    lambda: params.parse_zip(""),
    lambda: params.parse_zip("1' OR '1'='1"),
    lambda: params.parse_month("18", "02"),
    lambda: params.parse_month("2018", "13"),
    lambda: params.parse_month("2018", "0"),
    lambda: params.parse_month("2018", "٣"),
    lambda: params.parse_date_bound("2018-02-14"),
    lambda: params.parse_ssn(None),
    lambda: params.parse_card("  "),
    lambda: params.parse_top(0),
    lambda: params.parse_top(True),
    lambda: params.parse_top("10"),
])
def test_refuses_anything_else(call):
    with pytest.raises(ValueError):
        call()
