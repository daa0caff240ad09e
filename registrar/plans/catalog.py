"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

A query derives the domain tables from the test data (``Campus``), runs one
operator over the whole tables and projects a flat, comparable result. Column
names equal those of the matching SQL in ``plans/oracle.py``. Fixed parameters:
``year = 2000`` for top-N, ``as_of = 2001-12-31`` for the period report.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrar.functions.sequence import materialize
from registrar.operators import admission as A
from registrar.operators import grading as G
from registrar.operators import ingest as I
from registrar.operators import programs as P
from registrar.operators import quality as Q
from registrar.operators import reports as R
from registrar.streaming import admissions as SA
from registrar.streaming import balances as SB
from registrar.streaming import records as SR
from registrar.schema import PRIMARY_KEYS, SCHEMAS
from registrar.session import scratch_path
from registrar.sources.fixtures import Campus
from registrar.sources.requests import grade_bodies, parse_bodies, split_bodies
from registrar.sources.store import load_tables, store_tables
from registrar.sources.versions import StoredTable

TOP_YEAR = 2000
TOP_N = 3
AS_OF = "2001-12-31"
FIRST_AS_OF = "1992-12-31"  # every period counts

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: Callable[[Campus], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Campus(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return deco


# ---------------------------------------------------------------- reports

@query("transcript")
def _transcript(c: Campus) -> DataFrame:
    """W01 for every student."""
    return R.transcript(c)


@query("transcript_chosen")
def _transcript_chosen(c: Campus) -> DataFrame:
    """W01 for the students with ``id % 100 = 1``, given as a table."""
    chosen = c.student.select("user_id").where(F.col("user_id") % 100 == 1)
    return R.transcript(c, chosen)


def _offering(c: Campus, mode: str) -> DataFrame:
    out = R.offering_stats(c, None, mode).withColumn("instructors", R.as_array_text("instructors"))
    return out.drop("degree_id") if mode == "nonempty" else out


@query("offering_stats")
def _offering_stats(c: Campus) -> DataFrame:
    """W02, every degree, each enrolment counted once."""
    return _offering(c, "correct")


@query("offering_stats_degree")
def _offering_stats_degree(c: Campus) -> DataFrame:
    """W02 of one degree."""
    return R.offering_stats(c, 2).withColumn("instructors", R.as_array_text("instructors"))


@query("offering_stats_fanout")
def _offering_stats_fanout(c: Campus) -> DataFrame:
    """W02 with the reference's instructor fan-out in the counts."""
    return _offering(c, "fanout")


@query("offering_stats_nonempty")
def _offering_stats_nonempty(c: Campus) -> DataFrame:
    """W02, older variant: offerings with enrolments, no degree filter."""
    return _offering(c, "nonempty")


@query("top_n_by_average")
def _top_n(c: Campus) -> DataFrame:
    """Best 3 averages in 2000."""
    return R.top_n_by_average(c, TOP_YEAR, TOP_N)


@query("top_overall")
def _top_overall(c: Campus) -> DataFrame:
    """Best 3 averages over all years."""
    return R.top_n_by_average(c, None, TOP_N)


@query("nest_grades")
def _nest_grades(c: Campus) -> DataFrame:
    """The top-3 students' grade lists, one row per element."""
    d = R.top_n_details(c, TOP_YEAR, TOP_N)
    g = d.select("student_id", F.explode_outer("grades").alias("g"))
    return g.select("student_id", "g.course_edition_id", "g.course_edition_name", "g.grade", "g.date")


@query("nest_activities")
def _nest_activities(c: Campus) -> DataFrame:
    """The top-3 students' activity lists, one row per element."""
    d = R.top_n_details(c, TOP_YEAR, TOP_N)
    return d.select("student_id", F.explode_outer("activities").alias("activity"))


@query("top_by_group")
def _top_by_group(c: Campus) -> DataFrame:
    """Best average per district, ties kept."""
    return R.top_by_group(c, "district")


@query("evaluation_stats")
def _evaluation_stats(c: Campus) -> DataFrame:
    """W06 as of 2001-12-31."""
    return R.evaluation_stats(c, AS_OF)


@query("best_per_period")
def _best_per_period(c: Campus) -> DataFrame:
    """W07 over W06."""
    return R.best_per_period(R.evaluation_stats(c, AS_OF))


@query("missing_prerequisites")
def _missing_prerequisites(c: Campus) -> DataFrame:
    """W18 for every (student, course) with an enrolment."""
    pairs = (c.course_enrollment.select("student_id", "edition_id")
              .join(c.course_edition.select("edition_id", "course_code"), "edition_id"))
    out = R.missing_prerequisites(c, pairs)
    return out.withColumn("missing", F.array_join("missing", ","))


@query("seat_availability")
def _seat_availability(c: Campus) -> DataFrame:
    """W19 for every offering."""
    return R.seat_availability(c)


@query("stored_best_roster")
def _stored_best_roster(c: Campus) -> DataFrame:
    """The enrolments of the best offering of all periods, from enrolments stored by year."""
    names = ("course", "course_edition", "course_enrollment")
    root = scratch_path(c.spark, "by_year")
    store_tables(c, root, names)
    stored = load_tables(c.spark, root, names)
    R.best_offering(stored, FIRST_AS_OF).write.parquet(f"{root}/best")
    best = c.spark.read.parquet(f"{root}/best").where(F.col("approved") > 0)
    out = R.roster(stored, best)
    return out.withColumn("grade", F.col("grade").cast("double"))


# ---------------------------------------------------------------- admission

#: Tables that others are derived from: queries that read several of them derive these once.
SHARED = ("lines", "offering", "course_enrollment")


def _admitted(c: Campus) -> A.Outcome:
    c.keep(*SHARED, "admission_request")
    return A.admit_to_offering(c, c.admission_request)


@query("admit_to_offering")
def _admit(c: Campus) -> DataFrame:
    """Every signup request decided in arrival order."""
    return _admitted(c).outcome


@query("assign_classes")
def _assign_classes(c: Campus) -> DataFrame:
    """(student, class) rows of the requests whose classes all belong to the offering."""
    return A.assign_classes(c, c.admission_request)


@query("student_class_after_admission")
def _student_class_after(c: Campus) -> DataFrame:
    """The table of students' classes after the admissions."""
    return _admitted(c).tables["student_class"]


def _enrolment_out(df: DataFrame, *cols: str) -> DataFrame:
    return df.select("student_id", "edition_id", F.col("grade").cast("double").alias("grade"), *cols)


@query("enrollment_after_admission")
def _enrollment_after(c: Campus) -> DataFrame:
    """The enrolments after the admissions."""
    out = _admitted(c).tables["course_enrollment"]
    return _enrolment_out(out, "attendance", "evaluation_period")


# ---------------------------------------------------------------- ingest

@query("register_users")
def _register_users(c: Campus) -> DataFrame:
    """Student registrations."""
    return I.register_users(c, c.registration, "student").outcome


@query("register_users_json")
def _register_users_json(c: Campus) -> DataFrame:
    """W08 from JSON bodies, some of them cut short, wrapped in a list or followed by a comma: these
    are rejected as they came, the others registered."""
    r, seq = c.registration, F.col("seq")
    body = F.to_json(F.struct("username", "email", F.when(F.col("password_present"), F.concat(F.lit("p"), seq.cast("string"))).alias("password")))
    sent = r.select("seq", body.alias("body")).select("seq", (
        F.when(seq % 37 == 0, F.substring("body", F.lit(1), F.length("body") - 1)).when(seq % 41 == 0, F.concat(F.lit("["), "body", F.lit("]")))
         .when(seq % 43 == 0, F.concat("body", F.lit(" ,"))).otherwise(F.col("body"))).alias("body"))
    requests, rejects = split_bodies(sent, "registration")
    out = I.register_users(c, requests, "student").outcome
    return out.unionByName(rejects, allowMissingColumns=True)


def _registered(role: str) -> None:
    @query(f"users_after_{role}s")
    def users_after(c: Campus) -> DataFrame:
        """The users after registrations of a role."""
        return I.register_users(c, c.registration, role).tables["users"]

    @query(f"{role}s_registered")
    def registered(c: Campus) -> DataFrame:
        """The role's own table after registrations."""
        own = I.register_users(c, c.registration, role).tables[role]
        coordinator = F.col("is_coordinator") if role == "instructor" else F.lit(None).cast("boolean")
        return own.select("user_id", coordinator.alias("is_coordinator"))


for _role in ("student", "instructor", "admin"):
    _registered(_role)


def _absent(c: Campus):
    rows = c.registration.select("seq", "username", "email", F.lit("student").alias("role"))
    return I.insert_if_absent(c.users, rows, ["username"], "seq", id_col="user_id")


@query("insert_if_absent_outcome")
def _insert_if_absent_outcome(c: Campus) -> DataFrame:
    """What became of each registration inserted by username."""
    return _absent(c).outcome


@query("insert_if_absent")
def _insert_if_absent(c: Campus) -> DataFrame:
    """Registrations inserted into users keyed by username, conflicts ignored."""
    return _absent(c).tables["target"]


@query("enroll_degree")
def _enroll_degree(c: Campus) -> DataFrame:
    """Degree enrolment requests."""
    return I.enroll_degree(c, c.degree_request, AS_OF).outcome


@query("post_tuition")
def _post_tuition(c: Campus) -> DataFrame:
    """Accounts after posting the tuition of the accepted degree enrolments."""
    acc = I.enroll_degree(c, c.degree_request, AS_OF).tables["financial_account"]
    return acc.select("account_id", "student_id", F.col("balance").cast("double").alias("balance"))


@query("enroll_activity")
def _enroll_activity(c: Campus) -> DataFrame:
    """Activity enrolment requests with fee posting."""
    return I.enroll_activity(c, c.activity_request, AS_OF).outcome


@query("activity_balances")
def _activity_balances(c: Campus) -> DataFrame:
    """Accounts after the accepted activity fees."""
    acc = I.enroll_activity(c, c.activity_request, AS_OF).tables["financial_account"]
    return acc.select("account_id", "student_id", F.col("balance").cast("double").alias("balance"))


@query("erase_students")
def _erase_students(c: Campus) -> DataFrame:
    """Erasure requests."""
    return I.erase_students(c, c.erasure_request).outcome


@query("erase_students_tables")
def _erase_students_tables(c: Campus) -> DataFrame:
    """Row count of every table after the erasure."""
    res = I.erase_students(c, c.erasure_request)
    parts = [res.tables[name].agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, _ in I.student_tables()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _stored(c: Campus, name: str, keys=None, by=None) -> StoredTable:
    """A derived table, stored in as many buckets as the session shuffles into."""
    buckets = int(c.spark.conf.get("spark.sql.shuffle.partitions"))
    return StoredTable.create(getattr(c, name), scratch_path(c.spark, f"stored_{name}"), keys or PRIMARY_KEYS[name], by, buckets)


@query("stored_erasure")
def _stored_erasure(c: Campus) -> DataFrame:
    """W17 on stored tables: rows and residual rows of every table, read back from the versions written."""
    buckets = int(c.spark.conf.get("spark.sql.shuffle.partitions"))
    stored = I.store_student_tables(c, scratch_path(c.spark, "stored_students"), buckets)
    return I.erase_stored(stored, c.erasure_request).tables["confirmation"]


@query("stored_insert_if_absent")
def _stored_insert(c: Campus) -> DataFrame:
    """W09 on stored users keyed by username: the first registration of each name is inserted."""
    users = _stored(c, "users", keys=("username",))
    rows = c.registration.select("seq", "username", "email", F.lit("student").alias("role"))
    new = I.insert_if_absent(users.read(), rows, ["username"], "seq", id_col="user_id").tables["target"]
    users.insert_if_absent(new)
    return users.read()


@query("stored_tuition")
def _stored_tuition(c: Campus) -> DataFrame:
    """W11 on stored accounts: balances updated and accounts opened by one insert-else-update."""
    accounts = _stored(c, "financial_account", keys=("student_id",))
    taken = I.enroll_degree(c, c.degree_request, AS_OF).outcome.where("status = 'ok'")
    accounts.upsert(I.tuition_changes(accounts.read(), taken, c.degree_program, AS_OF))
    return accounts.read().select("account_id", "student_id", F.col("balance").cast("double").alias("balance"))


# ---------------------------------------------------------------- grading

@query("stored_grades")
def _stored_grades(c: Campus) -> DataFrame:
    """W15 on stored enrolments: the accepted grades applied by key."""
    c.keep("lines", "offering")
    stored = _stored(c, "course_enrollment", by=("student_id",))
    t = {"course_enrollment": stored.read(), "course_edition": c.course_edition}
    stored.update(G.submit_grades(t, c.grade_batch, c.grade_row).tables["grade_update"])
    return _enrolment_out(stored.read(), "evaluation_period")


def _graded(c: Campus):
    c.keep(*SHARED)
    return G.submit_grades(c, c.grade_batch, c.grade_row)


@query("submit_grades")
def _submit_grades(c: Campus) -> DataFrame:
    """Every grade batch accepted or rejected whole."""
    return _graded(c).outcome


@query("submit_grades_json")
def _submit_grades_json(c: Campus) -> DataFrame:
    """W15 from JSON bodies: a batch's rows in bodies of bounded length, parsed and joined again."""
    c.keep(*SHARED)
    bodies = grade_bodies(c.grade_batch, c.grade_row)
    return G.submit_grades(c, *G.split_batches(parse_bodies(bodies, "grade_batch"))).outcome


@query("enrollment_after_grades")
def _enrollment_after_grades(c: Campus) -> DataFrame:
    """The enrolments after the accepted batches."""
    return _enrolment_out(_graded(c).tables["course_enrollment"], "evaluation_period")


def _record_out(df: DataFrame) -> DataFrame:
    return df.select("record_id", "student_id", F.col("average").cast("double").alias("average"),
                     "approved_courses", "degree_id", "enrollment_date")


@query("academic_record")
def _academic_record(c: Campus) -> DataFrame:
    """W16 recompute after the accepted grade batches."""
    graded = _graded(c)
    t = {"course_enrollment": graded.tables["course_enrollment"], "academic_record": c.academic_record,
         "degree_enrollment": c.degree_enrollment}
    return _record_out(G.refresh_academic_record(t, "recompute"))


@query("academic_record_replay")
def _academic_record_replay(c: Campus) -> DataFrame:
    """W16 replay: the row trigger's counter and average over the grade updates."""
    graded = _graded(c)
    t = {"academic_record": c.academic_record, "degree_enrollment": c.degree_enrollment}
    rec = G.refresh_academic_record(t, "replay", changes=graded.tables["grade_change"],
                                    before=c.course_enrollment)
    return _record_out(rec)


@query("academic_record_incremental")
def _academic_record_incremental(c: Campus) -> DataFrame:
    """W16 kept up by signed deltas: the sums before the accepted batches and what these change."""
    graded = _graded(c)
    sums = materialize(G.passing_sums(c.course_enrollment))
    return _record_out(G.apply_grade_updates(c, sums, graded.tables["grade_update"])[0])


# ---------------------------------------------------------------- audit

AUDITED = tuple(SCHEMAS)


# ---------------------------------------------------------------- programmes, refunds, ledger

@query("activity_refunds")
def _activity_refunds(c: Campus) -> DataFrame:
    """Cancelled activities."""
    return P.cancel_activities(c, c.cancellation, AS_OF).outcome


@query("refund_balances")
def _refund_balances(c: Campus) -> DataFrame:
    """Accounts after the refunds."""
    acc = P.cancel_activities(c, c.cancellation, AS_OF).tables["financial_account"]
    return acc.select("account_id", "student_id", F.col("balance").cast("double").alias("balance"))


@query("charge_ledger")
def _charge_ledger(c: Campus) -> DataFrame:
    """Every charge with the balance after it."""
    out = P.charge_ledger(c.charge)
    return out.withColumn("amount", F.col("amount").cast("double")).withColumn("balance_after", F.col("balance_after").cast("double"))


@query("program_restriction")
def _program_restriction(c: Campus) -> DataFrame:
    """Enrolments inside and outside the student's programmes."""
    return P.program_restriction(c, c.course_enrollment)


@query("degree_progress")
def _degree_progress(c: Campus) -> DataFrame:
    """Credits passed and required per degree enrolment."""
    return P.degree_progress(c)


@query("passed_last_12_months")
def _passed_last_12_months(c: Campus) -> DataFrame:
    """P5: passes per course in the 12 months to 2001-12-31."""
    return P.most_passed(c, AS_OF)


#: Tables that follow row by row from a stored one: read from it, not stored once more.
FOLLOWING = ("course_edition", "course_enrollment", "class", "student_class", "class_assignment")


def _audited(c: Campus, changed: dict[str, DataFrame]) -> DataFrame:
    """The audit of the derived tables as they are stored, or follow row by row from stored ones."""
    root = scratch_path(c.spark, "audited")
    c.keep(*SHARED)
    tables = {n: getattr(c, n) for n in AUDITED} | changed
    stored = [n for n in AUDITED if n not in FOLLOWING]
    store_tables(tables, root, stored, by_year=False)
    return Q.audit_constraints({**tables, **load_tables(c.spark, root, stored)}, AUDITED)


@query("audit_constraints")
def _audit(c: Campus) -> DataFrame:
    """W20 on the derived tables."""
    return _audited(c, {})


@query("audit_constraints_faults")
def _audit_faults(c: Campus) -> DataFrame:
    """W20 on a copy with injected duplicate keys, orphans and bad class types."""
    c.keep(*SHARED)
    return _audited(c, Q.inject_faults({n: getattr(c, n) for n in AUDITED}))


# ---------------------------------------------------------------- streaming

@query("stream_balances")
def _stream_balances(c: Campus) -> DataFrame:
    """Tuition and activity charges streamed into running balances."""
    out = SB.balances_from_table(c.spark, c.charge)
    return out.select("student_id", F.col("balance").cast("double").alias("balance"), "n_charges")


@query("stream_admission")
def _stream_admission(c: Campus) -> DataFrame:
    """W13 over four deliveries of requests, decided one after the other with the state carried on."""
    names = ("course", "course_edition", "course_enrollment", "course_prerequisites", "student", "class", "student_class")
    root = scratch_path(c.spark, "admission_tables")
    c.keep(*SHARED, "admission_request")
    store_tables(c, root, names, by_year=False)  # each delivery reads them again
    state = SA.admissions_from_table(c.spark, load_tables(c.spark, root, names), c.admission_request, 4)
    return state.outcome().drop("delivery")


@query("stream_academic_record")
def _stream_academic_record(c: Campus) -> DataFrame:
    """The accepted grade updates streamed into running records."""
    changes = _graded(c).tables["grade_change"]
    return SR.records_from_changes(c.spark, c.course_enrollment, changes)


def queries() -> dict[str, QueryFn]:
    return dict(REGISTRY)
