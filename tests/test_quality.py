import pytest

from touchledger.config import QUALITY_THRESHOLDS, Threshold
from touchledger.operators import quality


@pytest.fixture
def inputs(frame):
    return {
        "sessions": frame("client_id string; channel string", ("k", "google_ads"), ("k", "direct"), ("x", "linkedin_ads"),
                          (None, "direct")),
        "spend": frame("clicks int", (2,), (2,)),
        "opps": frame("amount decimal(12,2); is_won boolean; is_missing_contact boolean; was_reopened boolean",
                      ("75.00", True, True, True), ("25.00", True, False, None), ("5.00", False, False, False)),
        "anchors": frame("amount decimal(12,2); is_won boolean; touch_count bigint", ("25.00", True, None), ("75.00", True, 3),
                         ("5.00", False, None)),
        "client_map": frame("client_id string", ("k",)),
        "id_contacts": frame("match_rule string", ("self",), ("phone_match",), *[("unmatched_personal",)] * 6),
        "touches": frame("source_system string; source_record_id string", ("clay", "g1"), ("clay", "g1"), ("ga4", "s")),
        "signals": frame("signal_id string", ("g1",), ("g2",)),
    }


def test_eight_checks(inputs):
    got = {r["check_name"]: (r["value"], r["status"]) for r in quality.data_quality(**inputs).collect()}
    assert got == {
        "utm_coverage_paid_clicks": (0.5, "warn"), "identified_session_share": (0.5, "ok"),
        "unattributed_won_revenue_share": (0.25, "warn"), "deals_missing_contact_share": (0.333, "warn"),
        "personal_email_contacts_merged": (1.0, "ok"), "personal_email_contacts_unmatched": (6.0, "warn"),
        "clay_signals_matched_share": (0.5, "warn"), "reopened_won_deals": (1.0, "ok")}


def test_thresholds_are_parameters_and_empty_inputs_do_not_divide_by_zero(inputs):
    empty = {k: v.filter("false") for k, v in inputs.items()}
    got = {r["check_name"]: (r["value"], r["status"]) for r in quality.data_quality(**empty).collect()}
    assert got["utm_coverage_paid_clicks"] == (None, "ok") and got["identified_session_share"] == (None, "ok")
    relaxed = quality.data_quality(**inputs, thresholds={"utm_coverage_paid_clicks": Threshold(0.5, "min")})
    status = {r["check_name"]: r["status"] for r in relaxed.collect()}
    assert status["utm_coverage_paid_clicks"] == "ok" and len(status) == len(QUALITY_THRESHOLDS)


def test_run_summary_and_recent_runs(inputs, frame):
    summary = quality.run_summary(inputs["opps"], quality.data_quality(**inputs)).first()
    assert (summary["opps"], summary["won"], float(summary["won_revenue_usd"]), summary["data_quality_warnings"]) == (3, 2, 100.0, 5)
    runs = frame("run_id bigint; started_at timestamp; finished_at timestamp; status string; summary string",
                 *[(i, None, None, "success", None) for i in range(20)])
    assert [r["run_id"] for r in quality.recent_runs(runs).collect()] == list(range(19, 5, -1))
