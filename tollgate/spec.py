"""Cascade specification: which steps are expected, and their day windows."""

from __future__ import annotations

from dataclasses import dataclass, field

POLICIES = ("any", "first", "earliest")
MODES = ("days", "timestamp")


@dataclass(frozen=True)
class StepWindow:
    """One expected follow-up step.

    ``name`` is the output column prefix, ``value`` the ``step_type`` value in the step
    log, and ``[lo, hi]`` the inclusive window in days after the anchor.
    """

    name: str
    value: str
    lo: int
    hi: int

    @property
    def label(self) -> str:
        return f"{self.lo}-{self.hi}"


@dataclass(frozen=True)
class CascadeSpec:
    """Steps, window mode and step-choice policy.

    mode
        ``days``: ``lo <= floor_days(step_ts - anchor) <= hi``;
        ``timestamp``: ``anchor + lo days <= step_ts <= anchor + hi days`` (exact instants).
    policy
        ``any``: a step is completed if any of its events falls in the window; the
        reported event is the earliest in-window one, else the earliest at/after the
        anchor.
        ``first``: only the earliest event at/after the anchor counts.
        ``earliest``: the earliest event at any time counts (days may be negative).
    """

    steps: tuple[StepWindow, ...]
    mode: str = "days"
    policy: str = "any"
    entity_col: str = "entity_id"
    anchor_col: str = "anchor_ts"
    step_col: str = "step_type"
    ts_col: str = "step_ts"
    cohort_cols: tuple[str, ...] = field(default_factory=tuple)

    def __post_init__(self):
        if self.policy not in POLICIES:
            raise ValueError(f"policy must be one of {POLICIES}, got {self.policy!r}")
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, got {self.mode!r}")
        names = [s.name for s in self.steps]
        if len(set(names)) != len(names) or not names:
            raise ValueError("step names must be unique and non-empty")
        for s in self.steps:
            if s.lo > s.hi:
                raise ValueError(f"window of {s.name} has lo > hi")

    def with_(self, **kw) -> "CascadeSpec":
        d = {k: getattr(self, k) for k in self.__dataclass_fields__}
        d.update(kw)
        return CascadeSpec(**d)

    @property
    def step_names(self) -> list[str]:
        return [s.name for s in self.steps]


# fixed values: the reference's four windows (days after the 18th birthday)
REFERENCE_STEPS = (
    StepWindow("biometric", "biometric", 0, 0),
    StepWindow("mobile", "mobile", 0, 30),
    StepWindow("address", "address", 31, 60),
    StepWindow("name", "name", 61, 90),
)
REFERENCE_SPEC = CascadeSpec(steps=REFERENCE_STEPS, cohort_cols=("state", "district", "gender", "urban_rural"))
