"""From raw rows to the two report tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgram.functions.measures import DISPLAY_MINIMUM
from cohortgram.functions.schemas import ORDER_KEYS
from cohortgram.functions.windows import ReportWindow
from cohortgram.operators import consolidate, evidence, marts, reconcile, rollup, select, vocabulary
from cohortgram.plans.storage import Scratch
from cohortgram.sources.seeds import Seeds
from cohortgram.sources.staging import stage_cohort

ORDER_ATTRIBUTES = ("culture_time_shifted", "ordering_mode", "culture_description", "was_positive")
ENDPOINT_COLUMNS = ("culture_organism_key", "organism", "antibiotic", "resolution_status", "susceptibility")
GROUP_KEYS = ("ast_scope", "reporting_source_key", *select.PATIENT_GROUP)
GROUP_PHENOTYPES = ("base", "esce_r", "oxacillin_resistant", "vancomycin_resistant")
REPORT_RELATIONS = ("endpoints", "records", "selected")
CULTURE = reconcile.PARENT
#: Stored relations with several readers that join or group on one key, and that key. All that is below a culture lies by the
#: culture, so that one shuffle, that of ``states``, serves them all.
BUCKET_KEYS = {
    "states": CULTURE,
    "cultures": CULTURE,
    "endpoints": CULTURE,
    "culture_organisms": CULTURE,
    "mapped": CULTURE,
    "phenotypes": CULTURE,
    "records": CULTURE,
    "selected": CULTURE,
    "group_endpoints": CULTURE,
    "first_stratified": CULTURE,
    "first_overall": CULTURE,
}
#: The same without audit columns: endpoints have no culture key then.
LEAN_BUCKET_KEYS = {
    "endpoints": "culture_organism_key",
    "culture_organisms": "culture_organism_key",
    "mapped": "culture_organism_key",
    "phenotypes": "culture_organism_key",
    "records": select.RECORD_KEY,
    "group_endpoints": "reporting_source_key",
}
WEIGHT = "staged_row_count"
AUDIT_RELATIONS = (
    *REPORT_RELATIONS,
    "states",
    "cultures",
    "culture_organisms",
    "mapped",
    "phenotypes",
    "group_endpoints",
    "first_stratified",
    "first_overall",
)


class ReportTables:
    """Every relation of a report, one property per grain, each built when first asked for.

    If ``scratch`` is given, the relations named in ``keep`` are written there once: by default those the
    reports read several times. Name more of them to run many audits over one build. Those whose readers join or group
    on one key (``BUCKET_KEYS``) are stored as buckets of it. With ``states`` among them, the raw rows are shuffled once, by culture, and
    all grains of the source are rolled up from there. Cultures, culture organisms, mapped records and phenotypes are stored when they are asked
    for; what is built from them takes them as stored, or else into its own tasks. Everything else stays a lazy plan for Catalyst. The window is applied to ``records``, before selection and counting; filtering
    a finished table would give other answers.

    ``audit_columns=False`` leaves out what no report reads: file lineage, ordering mode, row and distinct
    counts, label sets, source designations, and natural keys below the culture. That saves shuffles,
    sorting and storage.

    ``counts`` names, for a relation, aggregates to take while it is written, such as those of ``quality.written_counts``;
    ``counted`` holds what they gave.
    """

    def __init__(
        self,
        raw_cohort: DataFrame,
        seeds: Seeds,
        window: ReportWindow = ReportWindow(),
        scratch: Scratch | None = None,
        minimum: int = DISPLAY_MINIMUM,
        keep: Iterable[str] = REPORT_RELATIONS,
        audit_columns: bool = True,
        counts: Callable[[str], Mapping[str, Column]] | None = None,
    ):
        self.raw_cohort = raw_cohort
        self.seeds = seeds
        self.window = window
        self.scratch = scratch
        self.minimum = minimum
        self.keep = frozenset(keep)
        self.audit_columns = audit_columns
        self.lineage = rollup.LINEAGE if audit_columns else ()
        self.bucket_keys = BUCKET_KEYS if audit_columns else LEAN_BUCKET_KEYS
        self.record_keys = (CULTURE, "culture_organism_key") if audit_columns else ("culture_organism_key",)
        self.counts = counts
        self.counted: dict[str, dict[str, int]] = {}

    def for_window(self, window: ReportWindow) -> ReportTables:
        """The same tables under another window. What does not depend on the window is built once for both."""
        other = ReportTables(
            self.raw_cohort, self.seeds, window, self.scratch, self.minimum, self.keep, self.audit_columns, self.counts
        )
        for name in ("staged", "buckets", "endpoints", "records"):
            other.__dict__[name] = getattr(self, name)
            if name in self.counted:
                other.counted[name] = self.counted[name]
        return other

    def _plan_of(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A relation as the next step reads it: stored if a reader asked for it before, or else as a part of that step's own tasks."""
        return self.__dict__[name] if name in self.__dict__ else build()

    def _keep(self, name: str, frame: DataFrame) -> DataFrame:
        if self.scratch is None or name not in self.keep:
            return frame
        folder = f"{name}-{self.window.start or 'full'}"
        counts = self.counts(name) if self.counts else None
        if name in self.bucket_keys:
            kept = self.scratch.keep_by(folder, frame, self.bucket_keys[name], counts, self.buckets)
        else:
            kept = self.scratch.keep(folder, frame, counts=counts)
        if self.scratch.counted.get(folder):
            self.counted[name] = self.scratch.counted[folder]
        return kept

    # -- grains of the source ----------------------------------------------------------------------
    @cached_property
    def staged(self) -> DataFrame:
        return stage_cohort(self.raw_cohort)

    @cached_property
    def source_rows(self) -> int:
        return self.staged.count()

    @cached_property
    def buckets(self) -> int | None:
        """Buckets of all stored relations, which lie alike: their number grows with the source rows."""
        return self.scratch and self.scratch.buckets_for(self.source_rows)

    @cached_property
    def states(self) -> DataFrame:
        """Distinct staged rows with their number, by culture: what cultures, records and endpoints are rolled up from."""
        with self.scratch.splits_for(self.source_rows):
            folded = rollup.dealt_states(
                self.staged,
                ORDER_KEYS,
                (*ORDER_ATTRIBUTES, "organism", "antibiotic", "susceptibility", "source_file"),
                ("ingested_at",),
                CULTURE,
                WEIGHT,
                self.buckets,
            )
            return self._keep("states", folded)

    def _source(self) -> tuple[DataFrame, str | None]:
        """The rows to roll up, and the column with their numbers of source rows."""
        if self.scratch is not None and self.audit_columns and "states" in self.keep:
            return self.states, WEIGHT
        return self.staged, None

    @cached_property
    def cultures(self) -> DataFrame:
        return self._keep("cultures", self._cultures())

    def _cultures(self) -> DataFrame:
        attributes = ORDER_ATTRIBUTES if self.audit_columns else vocabulary.CONTEXT_COLUMNS
        rows, weight = self._source()
        return rollup.consistent_rollup(
            rows, ORDER_KEYS, attributes, "culture_key", lineage=self.lineage, weight=weight
        )

    @cached_property
    def culture_organisms(self) -> DataFrame:
        return self._keep("culture_organisms", self._culture_organisms())

    def _culture_organisms(self) -> DataFrame:
        rows, weight = self._source()
        return rollup.child_rollup(
            rows,
            ORDER_KEYS,
            "organism",
            "antibiotic",
            "culture_key",
            "culture_organism_key",
            lineage=self.lineage,
            item_counts=self.audit_columns,
            weight=weight,
        )

    @cached_property
    def endpoints(self) -> DataFrame:
        rows, weight = self._source()
        tested = rows.filter("organism is not null and antibiotic is not null")
        keys = [*([] if weight is None else [CULTURE]), *rollup.finest_first(ORDER_KEYS), "organism", "antibiotic"]
        rolled = reconcile.reconcile_endpoints(
            tested, keys, lineage=self.lineage, state_counts=self.audit_columns, weight=weight
        )
        keyed = reconcile.with_endpoint_keys(rolled, ORDER_KEYS)
        return self._keep("endpoints", keyed if self.audit_columns else keyed.select(*ENDPOINT_COLUMNS))

    @cached_property
    def exceptions(self) -> DataFrame:
        return reconcile.exceptions(self.endpoints)

    @cached_property
    def resolved(self) -> DataFrame:
        return reconcile.resolved_fact(self.endpoints)

    # -- vocabulary and cohorts --------------------------------------------------------------------
    @cached_property
    def organisms(self) -> DataFrame:
        labels = vocabulary.vocabulary(self.culture_organisms, "organism", "organism_source")
        return vocabulary.map_vocabulary(labels, self.seeds.labels)

    @cached_property
    def cohort_records(self) -> DataFrame:
        return self._cohort_records(self.culture_organisms, self.cultures)

    def _cohort_records(self, culture_organisms: DataFrame, cultures: DataFrame) -> DataFrame:
        keys = (CULTURE, *ORDER_KEYS) if self.audit_columns else ORDER_KEYS
        return vocabulary.assign_cohort(vocabulary.attach_culture_context(culture_organisms, cultures, keys))

    @cached_property
    def mapped(self) -> DataFrame:
        return self._keep("mapped", self._mapped())

    def _mapped(self) -> DataFrame:
        records = self._cohort_records(
            self._plan_of("culture_organisms", self._culture_organisms), self._plan_of("cultures", self._cultures)
        )
        labelled = records.withColumnRenamed("organism", "organism_source")
        return vocabulary.map_labels(labelled, self.seeds.labels)

    # -- classification and consolidation ----------------------------------------------------------
    @cached_property
    def evidence(self) -> DataFrame:
        narrow = self.endpoints.select(
            *self.record_keys,
            self.endpoints["organism"].alias("organism_source"),
            "antibiotic",
            "resolution_status",
            "susceptibility",
        )
        scoped = evidence.with_rule_scopes(vocabulary.map_labels(narrow, self.seeds.labels))
        return evidence.evidence_counts(scoped, keys=self.record_keys)

    @cached_property
    def phenotypes(self) -> DataFrame:
        return self._keep("phenotypes", self._phenotypes())

    def _phenotypes(self) -> DataFrame:
        mapped = self._plan_of("mapped", self._mapped)
        return evidence.phenotype_records(evidence.with_rule_scopes(mapped), self.evidence, keys=self.record_keys)

    @cached_property
    def records(self) -> DataFrame:
        categorised = consolidate.categorised_records(self._plan_of("phenotypes", self._phenotypes))
        return self._keep("records", consolidate.consolidate(categorised, audit_columns=self.audit_columns))

    # -- inside the window -------------------------------------------------------------------------
    @cached_property
    def observations(self) -> DataFrame:
        return consolidate.culture_observations(self.records, self.window)

    @cached_property
    def overall_observations(self) -> DataFrame:
        """Observations of the groups that have an overall row; the filter reaches the stored records."""
        return self.observations.filter(self.observations["organism_reporting_group"].isin(*select.OVERALL_GROUPS))

    @cached_property
    def group_endpoints(self) -> DataFrame:
        """Second reconciliation of every overall and stratified group in the window."""
        usable = self.records.filter(self.window.usable("culture_time_shifted"))
        stratified = usable.filter(usable["reporting_phenotype"].isin(*GROUP_PHENOTYPES))
        # Under a name of its own, or else Spark does not see that both scopes lie by it and deals their union again.
        parent = {c: f"_{c}" for c in reconcile.shared_parent(self.records, self.endpoints)}
        groups = reconcile.scope_groups(
            {
                "overall": (self.overall_observations, "reporting_culture_observation_key"),
                "stratified": (stratified, select.RECORD_KEY),
            },
            (*[F.col(c).alias(name) for c, name in parent.items()], *select.PATIENT_GROUP),
            consolidate.MEMBERS,
        )
        endpoints = self.endpoints.withColumnsRenamed(parent)
        rolled = reconcile.reconcile_group(groups, endpoints, GROUP_KEYS, parent=list(parent.values()))
        rolled = rolled.withColumnsRenamed({name: c for c, name in parent.items()})
        return self._keep("group_endpoints", reconcile.with_group_endpoint_key(rolled))

    @cached_property
    def markers(self) -> DataFrame:
        """Marker results of the window's records from their endpoints; ``records`` carry the same as columns."""
        usable = self.records.filter(self.window.usable("culture_time_shifted"))
        return select.marker_agreement(select.marker_endpoints(usable, self.endpoints))

    @cached_property
    def candidates(self) -> DataFrame:
        return select.stratified_candidates(self.records, self.window)

    @cached_property
    def first_stratified(self) -> DataFrame:
        return self._keep("first_stratified", select.first_per_category(self.candidates))

    @cached_property
    def first_overall(self) -> DataFrame:
        return self._keep("first_overall", select.first_overall(self.overall_observations))

    @cached_property
    def first_stratified_endpoints(self) -> DataFrame:
        return select.attach_stratified_endpoints(self.first_stratified, self.group_endpoints)

    @cached_property
    def first_overall_endpoints(self) -> DataFrame:
        return select.attach_overall_endpoints(self.first_overall, self.group_endpoints)

    # -- reports -----------------------------------------------------------------------------------
    @cached_property
    def population(self) -> DataFrame:
        return marts.union_populations(self.first_overall, self.first_stratified)

    @cached_property
    def population_endpoints(self) -> DataFrame:
        return marts.union_endpoints(self.first_overall_endpoints, self.first_stratified_endpoints)

    @cached_property
    def selected(self) -> DataFrame:
        """Selected records of both scopes; the table reads them for its denominators and its endpoints."""
        return self._keep("selected", marts.selected_members(self.first_overall, self.first_stratified))

    @cached_property
    def susceptibility(self) -> DataFrame:
        return marts.susceptibility_mart(
            self.selected,
            self.endpoints,
            self.seeds.pairs,
            self.seeds.exclusions,
            self.seeds.groups,
            self.window,
            self.minimum,
        )

    @cached_property
    def mdro(self) -> DataFrame:
        return marts.mdro_mart(self.records, self.seeds.groups, self.window)
