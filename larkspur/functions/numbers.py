"""Number expressions."""

from pyspark.sql import functions as F

NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def parse_number(c):
    """Text to double; anything that is not a plain number gives NULL. May be infinite: see ``finite``."""
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def finite(c):
    """NULL for infinity; apply it to a finished column, which it reads twice."""
    return F.when(F.abs(c) < float("inf"), c)


def whole_or_zero(c):
    """Number cut at the point; missing or too large gives 0."""
    return F.coalesce(c.try_cast("int"), F.lit(0))


def risk_score(monthly, tenure, contract, monthly_scale=120.0, tenure_scale=72.0,
               month_to_month="Month-To-Month"):
    """0.3 of the charge share, 0.4 of the missing tenure share, 0.3 for a monthly contract."""
    is_monthly = F.coalesce((contract == month_to_month).cast("int"), F.lit(0))
    return (
        monthly / F.lit(monthly_scale) * F.lit(0.3)
        + (F.lit(1.0) - tenure / F.lit(tenure_scale)) * F.lit(0.4)
        + is_monthly * F.lit(0.3)
    )


def hashed_uniform(key, salt):
    """A repeatable number in [0, 1) per key: 32 bits of a digest."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(salt))), 1, 8), 16, 10)
    return bits.cast("double") / F.lit(4294967296.0)


def bernoulli(p, key, salt):
    """1 with probability ``p``, repeatable per key."""
    return (hashed_uniform(key, salt) < p).cast("int")


def uniform_int(low, high, key, salt):
    """Whole number in [low, high), repeatable per key."""
    return (F.lit(low) + F.floor(hashed_uniform(key, salt) * F.lit(float(high - low)))).cast("int")


def uniform_real(low, high, key, salt, digits=2):
    return F.round(F.lit(float(low)) + hashed_uniform(key, salt) * F.lit(float(high - low)), digits)


def choice(values, key, salt):
    """One of ``values``, repeatable per key."""
    place = F.floor(hashed_uniform(key, salt) * F.lit(float(len(values)))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), place)
