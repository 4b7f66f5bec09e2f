"""IPv4 addresses as integers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_ADDRESS = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"


def ip_to_long(address: Column) -> Column:
    """Dotted address to integer; null when it is not four numbers from 0 to 255."""
    octets = [F.try_element_at(F.split(address, r"\."), F.lit(i)).try_cast("bigint") for i in (1, 2, 3, 4)]
    in_range = octets[0].between(0, 255)
    for octet in octets[1:]:
        in_range = in_range & octet.between(0, 255)
    number = (
        F.shiftleft(octets[0], 24) + F.shiftleft(octets[1], 16) + F.shiftleft(octets[2], 8) + octets[3]
    )
    return F.when(address.rlike(_ADDRESS) & in_range, number)


def long_to_ip(number: Column) -> Column:
    """Integer to dotted address; null outside the 32-bit range."""
    octets = [F.shiftright(number, shift).bitwiseAND(F.lit(255)) for shift in (24, 16, 8, 0)]
    return F.when(number.between(0, 2**32 - 1), F.concat_ws(".", *[o.cast("string") for o in octets]))
