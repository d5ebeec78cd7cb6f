"""Parameter objects. Every business constant of the pipeline lives here."""

from __future__ import annotations

from dataclasses import dataclass, field

# Above this many rows one group is not handed to a single task; see
# functions/quantiles.py for the path such groups take.
HOT_ROWS = 2_000_000

# A company with more snapshot rows than this is cut into slices of the order;
# see operators/sliced.py. A growing median costs more the longer the frame is.
RUNNING_ROWS = 20_000

# Plan names and their ordinals.
PLAN_ORDINALS = {"basic": 0, "professional": 1, "business": 2, "enterprise": 3}
EXCLUDED_PLANS = ("enterprise", "aplicateca2", "aplicateca5")
PREMIUM_PLANS = (1, 2)

# Lifecycle actions.
SIGNUP = "alta"
UPGRADE = "upgrade"
CANCEL = "baixa"
PREMIUM_END_ACTIONS = ("baixa", "downgrade", "devolucio")
ACTIVE_ACTIONS = ("alta", "upgrade", "renovacio", "reactivacio")
SWITCH_ACTIONS = ("autorenovacio on", "autorenovacio off")
DEMO_PAYMENT = "FreeDemo"

# Records that are never analysed.
TEST_COMPANY_NAMES = ("Pruebas PRE 917080021",)
PLACEHOLDER_PARTIES = ("#personal xin", "#personal num")
PLACEHOLDER_OWNERS = ((105288, "#personal xin"), (151379, "#personal xin"))
MIN_COMPANY_ID = 10
EXCLUDED_COMPANIES = (504,)

# Transaction states that count as failed.
FAILED_STATES = (
    "refused", "error", "discarded", "cancelled", "ocr_failed",
    "quote_expired", "quote_error", "quote_refused",
)

# Channel groups in the order the dominant channel is decided.
CHANNEL_FLAGS = {
    "b2g": "B2G",
    "mail": "Mail",
    "downloads": "Downloads",
    "other": "Other",
    "peppol": "Peppol",
    "b2brouter": "B2Brouter",
}

# Raw channel codes of each group.
CHANNEL_GROUPS = {
    "B2G": (
        "facturae_32_cabb", "osakidetza", "facturae_32_xunta",
        "facturae_32_junta_andalucia", "facturae_32_efaktur", "facturae_32_face",
        "facturae_32_face_detached", "biscaytik", "dfbizkaia", "dfalava",
        "facturae_32_canaries", "facturae_32_jccm", "gipuzkoa",
        "facturae_32_vitoria", "facturae_32_govern_basc", "es_publico", "aoc32",
        "facturae_32_rioja", "facturae_32_junta_an", "facturae_32",
        "facturae_32_jcyl", "link_to_facturae32_b", "facturae_32_govern_b",
        "send_fatturapa", "send_efaturagov", "send_chorus", "send_espap",
        "send_fe_ap", "andorra",
    ),
    "Peppol": (
        "peppol_dh_ubl", "peppol", "peppol_xrechnung", "peppol_nl_cius",
        "peppol_zugferd", "peppol_anz", "peppolbis21", "peppolbis30",
        "ublinvoice_20", "chorus_ubl",
    ),
    "Mail": (
        "xml_by_mail_facturae32", "xml_by_mail_fatturapa",
        "xml_by_mail_xrechnung", "xml_by_mail_zugferd",
        "xml_by_mail_chorus_ubl", "xml_by_mail_nlcius_ubl",
        "xml_by_mail_svefaktura", "pdf_by_mail", "email",
        "link_to_pdf_by_mail", "link_to_facturae32_by_mail",
    ),
    "Other": (
        "send_bsabadell", "b2bconecta", "facturae_322_faceb2b_detached",
        "facturae_322_faceb2b", "send_vocento", "send_serhs", "send_gmfood",
        "faceb2b", "pagero", "seres32", "from_issued", "signed_pdf", "web_form",
        "gefact", "uploaded", "wesupply", "send_ariadne", "sdi", "sftp",
        "uploaded_csv", "inditex", "send_edicom", "send_ediversa",
        "send_ediversa_d96a", "send_bonpreu", "send_carrefour",
        "send_carrefour_socomo", "send_carrefour_mercancias", "send_eci",
        "edicom", "send_eprior_prod", "paper", "carrefour", "carrefour-supeco",
        "new", "carrefour-champion", "carrefour-hipermercados",
        "carrefour-mercancias", "carrefour-plataformas", "carrefour-socomo",
        "carrefour-supersol",
    ),
    "Downloads": (
        "download_svefaktura", "download_signed_pdf", "download_pdf",
        "download_ubl", "download_nlcius_ubl", "download_chorus_ubl",
        "download_zugferd", "download_xrechnung", "download_fatturapa",
        "download_facturae",
    ),
    "B2Brouter": ("b2brouter",),
}


@dataclass(frozen=True)
class SnapshotSpec:
    """How the history is cut into snapshots.

    window "period" looks at the transactions of the snapshot's own period,
    "trailing" at the last n_periods periods. first_after drops, from the
    first snapshot's window only, periods up to and including that period.
    The date limits are yyyymm bounds: from inclusive, before exclusive.
    yyyymm_arithmetic and senders_only reproduce two literal behaviours: a
    trailing window that never crosses a year end, and partner counts only
    for parties that sent something.
    """

    grain: str = "month"
    window: str = "period"
    n_periods: int = 3
    first_after: str | None = None
    lifecycle_from: str | None = None
    lifecycle_before: str | None = None
    transactions_before: str | None = None
    registry_before: str | None = None
    yyyymm_arithmetic: bool = False
    senders_only: bool = False
    hot_rows: int = HOT_ROWS
    running_rows: int = RUNNING_ROWS

    @property
    def trailing(self) -> bool:
        return self.window == "trailing"


# The two products of the pipeline.
RFM_SNAPSHOTS = SnapshotSpec()
TEMPORAL_SNAPSHOTS = SnapshotSpec(
    window="trailing",
    lifecycle_from="201907",
    lifecycle_before="202203",
    transactions_before="202203",
    registry_before="2022-03-01",
)


@dataclass(frozen=True)
class RfmBounds:
    """Upper bounds of the amount and frequency scores 1, 2 and 3."""

    amount: tuple[float, float, float]
    frequency: tuple[float, float, float]


PREMIUM_BOUNDS = RfmBounds((200, 1100, 5000), (0, 1, 4))
BASIC_BOUNDS = RfmBounds((0, 5000, 50000), (0, 1, 2))
RECENCY_BOUNDS = (30, 95, 365)


@dataclass(frozen=True)
class SegmentRule:
    """A segment name and the SQL condition that selects it."""

    name: str
    when: str


DOWNGRADED = "days_until_last_transaction < days_since_baixa_prem"

# Rules apply in order; the first that holds decides.
BASIC_RULES = (
    SegmentRule("Downgrades", DOWNGRADED),
    SegmentRule("Recent clients", "r >= 3 AND sum_transactions = 0"),
    SegmentRule("Lost", "r = 1 AND sum_transactions > 0"),
    SegmentRule("Inactive", "r < 3 AND sum_transactions = 0"),
    SegmentRule("Low engagement", "receivers = 1"),
    SegmentRule("Normal", "r >= 2 AND f >= 3"),
    SegmentRule("Normal", "r >= 3 AND f = 2 AND m <> 4"),
    SegmentRule("Bullies", "r >= 3 AND f >= 2 AND m = 4"),
    SegmentRule("Potential premiums", "r >= 4 AND f >= 3 AND m = 3"),
    SegmentRule("Sporadic", "r = 2 AND f = 2"),
    SegmentRule("Sporadic", "r >= 2 AND f = 1"),
)
PREMIUM_RULES = (
    SegmentRule("Downgrades", DOWNGRADED),
    SegmentRule("Recent clients", "r >= 3 AND sum_transactions = 0"),
    SegmentRule("Almost lost", "r <= 2"),
    SegmentRule("Low engagement", "receivers = 1"),
    SegmentRule("Big companies", "r >= 3 AND f >= 2 AND m = 4"),
    SegmentRule("Loyals", "r >= 3 AND f >= 3 AND m < 4"),
    SegmentRule("Normal", "r >= 3 AND f = 2 AND m < 4"),
    SegmentRule("Sporadic", "r >= 3 AND f = 1"),
)


@dataclass(frozen=True)
class BoostedTrees:
    """Boosted-tree parameters; positive_weight is the weight of class 1."""

    n_estimators: int = 100
    learning_rate: float = 0.01
    max_depth: int = 2
    subsample: float = 0.5
    positive_weight: float = 2.0
    column_share: float = 0.7
    min_rows_per_leaf: int = 1
    min_gain: float = 0.0
    seed: int = 1


CHURN_TREES = BoostedTrees()
UPSELL_TREES = BoostedTrees(
    n_estimators=110, max_depth=3, subsample=0.6, positive_weight=3.0, min_gain=15.0
)


@dataclass(frozen=True)
class SplitSpec:
    """Shares of the train/test split; whole_test truncates the test size first."""

    train_share: float = 0.75
    negatives_per_positive: int = 3
    whole_test: bool = True
    seed: int = 1


CHURN_SPLIT = SplitSpec()
UPSELL_SPLIT = SplitSpec(whole_test=False)


@dataclass(frozen=True)
class Correction:
    """One data fix on the lifecycle table.

    op "delete" removes the rows that match; op "swap" exchanges the
    timestamps of the row matching `match` and the one matching `other`.
    """

    op: str
    match: dict = field(default_factory=dict)
    other: dict = field(default_factory=dict)
