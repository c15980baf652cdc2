"""Target tables of the eight reporting marts: one ``TargetSpec`` per table.

A spec is the single source of truth for a target: column order and types
(with VARCHAR lengths kept as field metadata), NOT NULL columns, the surrogate
auto-increment column, the unique key used by ``insert_ignore`` and the load
mode. Spark types: INT -> int, BIGINT -> bigint, TINYINT -> tinyint,
DECIMAL(p,s) -> decimal(p,s), VARCHAR(n)/TEXT -> string, DATE -> date,
DATETIME -> timestamp_ntz, TIMESTAMP -> timestamp.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

VARCHAR_META = "varchar_length"

_DECIMAL = re.compile(r"decimal\((\d+),(\d+)\)")
_VARCHAR = re.compile(r"varchar\((\d+)\)")


def spark_type(sql_type: str) -> tuple[T.DataType, int | None]:
    """Map one target column type (lower case, no blanks) to a Spark type and VARCHAR length."""
    t = sql_type.lower().replace(" ", "")
    simple = {
        "int": T.IntegerType(),
        "bigint": T.LongType(),
        "tinyint": T.ByteType(),
        "text": T.StringType(),
        "date": T.DateType(),
        "datetime": T.TimestampNTZType(),
        "timestamp": T.TimestampType(),
        "double": T.DoubleType(),
    }
    if t in simple:
        return simple[t], None
    m = _DECIMAL.fullmatch(t)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2))), None
    m = _VARCHAR.fullmatch(t)
    if m:
        return T.StringType(), int(m.group(1))
    raise ValueError(f"unsupported target type {sql_type!r}")


@dataclass(frozen=True)
class TargetSpec:
    """A reporting table: columns, constraints and how it is loaded."""

    name: str
    columns: tuple[tuple[str, str], ...]  # (column, sql type) in table order
    not_null: tuple[str, ...] = ()
    surrogate: str | None = None  # auto-increment column, assigned at load
    key: tuple[str, ...] = ()  # unique key honoured by insert_ignore
    mode: str = "insert_ignore"  # insert_ignore | append | full_refresh
    order: tuple[str, ...] = ()  # arrival order of the source query (ORDER BY)
    key_collation: str | None = None  # e.g. UTF8_LCASE for case-insensitive keys
    notes: dict = field(default_factory=dict)

    def field(self, name: str) -> T.StructField:
        for f in self.schema.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    @property
    def schema(self) -> T.StructType:
        """Full table schema, surrogate included."""
        fields = []
        for name, sql in self.columns:
            dt, n = spark_type(sql)
            meta = {VARCHAR_META: n} if n else {}
            nullable = name not in self.not_null and name != self.surrogate
            fields.append(T.StructField(name, dt, nullable, meta))
        return T.StructType(fields)

    @property
    def load_schema(self) -> T.StructType:
        """Columns the mart query delivers (everything but the surrogate)."""
        return T.StructType([f for f in self.schema.fields if f.name != self.surrogate])

    @property
    def load_columns(self) -> list[str]:
        return [f.name for f in self.load_schema.fields]


def _cols(text: str) -> tuple[tuple[str, str], ...]:
    """``name type`` per line -> tuple of pairs (the type may contain a comma)."""
    out = []
    for line in text.strip().splitlines():
        name, sql = line.split(None, 1)
        out.append((name, sql.strip()))
    return tuple(out)


# ---------------------------------------------------------------------------
# The eight target tables exactly as the reporting schema
# declares them (column names, order, types, NOT NULL, keys).
# ---------------------------------------------------------------------------

BANK = TargetSpec(
    name="bank",
    columns=_cols(
        """
        id int
        user_id int
        bank_name varchar(255)
        ac_name varchar(255)
        ac_no varchar(100)
        branch varchar(255)
        swift_code varchar(50)
        iban varchar(100)
        home_address text
        """
    ),
    not_null=("user_id",),
    surrogate="id",
    key=("user_id",),
    mode="insert_ignore",
)

CAMPAIGN = TargetSpec(
    name="campaign",
    columns=_cols(
        """
        id int
        campaign_id int
        order int
        title varchar(500)
        short_desc text
        user_id int
        progress_type_id int
        start_date datetime
        end_date datetime
        min_amount decimal(18,2)
        max_amount decimal(18,2)
        project_timeline varchar(255)
        max_predefined_amount decimal(18,2)
        min_predefined_amount decimal(18,2)
        funding_goal decimal(18,2)
        currency varchar(50)
        max_equity_offered decimal(10,2)
        min_equity_offered decimal(10,2)
        divident_target decimal(10,2)
        roi_after_tax decimal(10,2)
        irr_after_tax decimal(10,2)
        recommended_amount decimal(18,2)
        contributor_table varchar(255)
        location varchar(255)
        country_name varchar(255)
        admin_aproval tinyint
        draft tinyint
        approved_by int
        approved_at datetime
        timeline_start_date datetime
        timeline_end_date datetime
        payout_notify tinyint
        created_at datetime
        deleted_at datetime
        updated_at datetime
        campaign_type varchar(100)
        campaign_end_method varchar(100)
        campaign_opened_at datetime
        campaign_closed_at datetime
        status varchar(50)
        is_public tinyint
        is_private tinyint
        meta_title varchar(500)
        campaign_close_request tinyint
        user_type_id int
        """
    ),
    not_null=("campaign_id",),
    surrogate="id",
    key=("campaign_id",),
    mode="insert_ignore",
    order=("campaign_id",),
)

CAMPAIGN_TRANSACTIONS = TargetSpec(
    name="campaign_transactions",
    columns=_cols(
        """
        id bigint
        payment_request_id bigint
        issuer_disbursed_request_id bigint
        investor_disbursed_request_id bigint
        pre_campaign_fee_request_id bigint
        campaign_transactions_id bigint
        investor_id bigint
        issuer_id bigint
        transaction_no varchar(100)
        transaction_type varchar(100)
        transaction_status varchar(100)
        payment_method varchar(100)
        amount decimal(18,2)
        charge decimal(18,2)
        currency varchar(10)
        rate decimal(18,6)
        base_amount decimal(18,2)
        base_currency varchar(10)
        investment_status varchar(100)
        status varchar(50)
        remarks text
        transaction_date datetime
        deal_id bigint
        deleted_at datetime
        created_at datetime
        updated_at datetime
        affiliate_code varchar(100)
        """
    ),
    not_null=("id",),
    key=("id",),
    mode="insert_ignore",
)

# issuer_onboardings: 115 columns in table order (too long for an inline block).
_ISSUER_COLUMNS = """
id bigint
campaign_id bigint
issuer_id int
issuer_type varchar(50)
email varchar(255)
phone_code varchar(10)
phone_no varchar(15)
application_type varchar(50)
fnc text
crn text
co text
nbi text
cpbd text
cc text
cpuc varchar(50)
min_fag decimal(18,2)
max_fag decimal(18,2)
bdbdypuf varchar(50)
lar varchar(50)
lani varchar(50)
dcp varchar(50)
pt text
nas varchar(255)
c_addr text
business_activities text
company_type varchar(50)
wldypc varchar(50)
hdyae varchar(50)
ihdccetc varchar(50)
ajc_ecf varchar(50)
ajc_p2p varchar(50)
cbl varchar(50)
ci varchar(50)
gambling varchar(50)
llra varchar(50)
ppra varchar(50)
nhfb varchar(50)
snce varchar(50)
ttra varchar(50)
iicai varchar(50)
dsnci varchar(50)
oadcaspd varchar(50)
tscrp varchar(50)
trpcg varchar(50)
share_t varchar(50)
stock_bb varchar(50)
rrsca varchar(50)
oadncaspd varchar(50)
tsncrp varchar(50)
ba_trpcg varchar(50)
total_a decimal(18,2)
tcsti decimal(18,2)
sncsstii decimal(18,2)
t_debt decimal(18,2)
sncdi varchar(50)
jurisdictional_delaration text
df varchar(50)
itapullrgcoipss varchar(50)
iaaosptcrllralra varchar(50)
sfridspvydsmdabq varchar(50)
afsqaateaullreeci varchar(50)
werallraocpcbbocpospi varchar(50)
gldr varchar(50)
lrfcafoc varchar(50)
tmpfoac varchar(50)
trfievorrsic varchar(50)
tsdrcj varchar(50)
icacsafsr varchar(50)
atalcfer varchar(50)
aftijfojp varchar(50)
atarpoafpdhjraptfo varchar(50)
wcssi varchar(50)
declaration varchar(50)
foreign_ownship varchar(50)
fa_afs_lstt varchar(50)
fa_afs_mrtt varchar(50)
itbs varchar(50)
obligation varchar(50)
transparancy varchar(50)
weisde_taohl varchar(50)
iccne varchar(50)
tciiicp_usd decimal(18,2)
tams varchar(50)
agr_cmi varchar(50)
ip_oic varchar(50)
pfc varchar(50)
atarftjioj varchar(50)
operation_key_management varchar(50)
min_rev decimal(18,2)
shareholder_wicl varchar(50)
bank_ac_wicl varchar(50)
public_lcco varchar(50)
bounce_cmfr varchar(50)
cur_litigation_apac varchar(50)
shdircom varchar(50)
negative_equity_bl varchar(50)
risk_scoring varchar(50)
no_current_dispute varchar(50)
project_fscfi varchar(50)
clear_role_pos varchar(50)
completed_project_fpf varchar(50)
future_payment_fpf varchar(50)
company_awarded_payor varchar(50)
completed_project_fif varchar(50)
future_payment_fif varchar(50)
disclose_srr varchar(50)
asset_dnuc varchar(50)
on_boarding varchar(50)
dd_ongoing varchar(50)
ic_approval varchar(50)
on_boarding_status varchar(50)
submission_date datetime
pre_campaign_fee decimal(18,2)
created_at datetime
updated_at datetime
"""

ISSUER_ONBOARDINGS = TargetSpec(
    name="issuer_onboardings",
    columns=_cols(_ISSUER_COLUMNS),
    not_null=("campaign_id", "issuer_id"),
    surrogate="id",
    key=("campaign_id", "issuer_id"),
    mode="full_refresh",
)

REFERRALS = TargetSpec(
    name="referrals",
    columns=_cols(
        """
        id bigint
        referred_user_id bigint
        campaign_id bigint
        commission_amount decimal(18,2)
        commission_percentage decimal(10,2)
        referral_user_id int
        status varchar(50)
        created_at datetime
        updated_at datetime
        """
    ),
    not_null=("id",),
    key=("id",),
    mode="insert_ignore",
)

USERS = TargetSpec(
    name="users",
    columns=_cols(
        """
        id int
        user_id int
        email varchar(255)
        full_name varchar(255)
        role_id int
        email_verified_at datetime
        investor_category_id int
        phone_code varchar(10)
        phone varchar(50)
        is_approved tinyint
        login_with varchar(50)
        is_admin tinyint
        user_created_at datetime
        user_updated_at datetime
        gender varchar(20)
        dob date
        namescan_id varchar(100)
        namescan_match_rate decimal(5,2)
        kyc_general_match_status varchar(100)
        platform_ref varchar(100)
        maala_result text
        country varchar(100)
        user_type varchar(100)
        aml_record text
        kyc_id int
        kyc_info_id int
        kyc_investor_category_id int
        annual_salary varchar(100)
        net_worth varchar(1000)
        kyc_status varchar(100)
        investor_category_title varchar(255)
        investor_category_type varchar(255)
        Malaa_Civil_Number varchar(100)
        Malaa_Name1 varchar(255)
        Malaa_Name2 varchar(255)
        Malaa_Name3 varchar(255)
        Malaa_LastName varchar(255)
        Malaa_Gender varchar(50)
        Malaa_Date_Of_Birth date
        Malaa_Birth_Country varchar(255)
        Malaa_Address text
        Malaa_Mobile varchar(100)
        Malaa_Occupation varchar(255)
        Malaa_Passport_Number varchar(100)
        Malaa_Passport_Issue_Date date
        Malaa_Passport_Expiry_Date date
        """
    ),
    not_null=("user_id",),
    surrogate="id",
    key=(),  # the unique key is commented out in the DDL: every run appends a snapshot
    mode="append",
    order=("user_id",),
)

WALLET_ADD_FUNDS = TargetSpec(
    name="wallet_add_funds",
    columns=_cols(
        """
        id int
        user_id int
        add_funds_amount decimal(18,2)
        add_funds_currency varchar(10)
        add_funds_base_currency_USD varchar(10)
        add_funds_converted_amount_USD decimal(15,2)
        add_funds_updated_amount decimal(15,2)
        add_funds_date date
        add_funds_payment_type bigint
        add_funds_transaction_id varchar(255)
        add_funds_status varchar(255)
        add_funds_created_at timestamp
        add_funds_updated_at timestamp
        """
    ),
    not_null=("user_id", "add_funds_transaction_id"),
    surrogate="id",
    key=("add_funds_transaction_id",),
    mode="full_refresh",
    order=("user_id",),
)

WALLET_WITHDRAW_FUNDS = TargetSpec(
    name="wallet_withdraw_funds",
    columns=_cols(
        """
        id int
        user_id bigint
        withdraw_funds_amount varchar(255)
        withdraw_funds_currency varchar(3)
        withdraw_funds_base_currency varchar(3)
        withdraw_funds_exchange_rate decimal(16,8)
        withdraw_funds_converted_amount decimal(16,2)
        withdraw_funds_remaining_balance varchar(255)
        withdraw_funds_bank_id varchar(255)
        withdraw_funds_payment_type bigint
        withdraw_funds_status bigint
        withdraw_funds_created_at datetime
        withdraw_funds_updated_at datetime
        bank_name varchar(255)
        account_name varchar(255)
        account_num varchar(255)
        country_id bigint
        branch varchar(255)
        iban varchar(255)
        home_address text
        swift_code varchar(255)
        """
    ),
    surrogate="id",
    key=("withdraw_funds_bank_id",),  # nullable: NULL keys never collide
    mode="insert_ignore",
    order=("user_id",),
)

TARGETS: dict[str, TargetSpec] = {
    t.name: t
    for t in (
        BANK,
        CAMPAIGN,
        CAMPAIGN_TRANSACTIONS,
        ISSUER_ONBOARDINGS,
        REFERRALS,
        USERS,
        WALLET_ADD_FUNDS,
        WALLET_WITHDRAW_FUNDS,
    )
}
