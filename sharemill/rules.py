"""Business rules as data. Operators take these as arguments and hold no names of their own."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

# LIKE patterns over upper-cased network names, first match wins.
NETWORK_LABELS = (
    ("STAR%", "Star"),
    ("SONY%", "Sony"),
    ("VIACOM%", "Viacom"),
    ("SUN%", "Sun"),
    ("ZEE%ENTERTAINMENT%", "Zee"),
)

# The genre mart uses a wider last pattern.
GENRE_LABELS = (
    ("STAR%", "Star"),
    ("SONY%", "Sony"),
    ("VIACOM%", "Viacom"),
    ("SUN%", "Sun"),
    ("ZEE%", "Zee"),
)

# Groups reported in the marts (compared upper-cased).
REPORTED = ("ZEE", "STAR", "VIACOM", "SUN", "SONY")

# Competition bucket of each channel label (compared upper-cased).
BUCKETS = {
    1: (
        "&TV", "COLORS", "JEET PRIME(V)", "LIFE OK(NA)", "SONY SAB", "SONY ENTERTAINMENT TELEVISION",
        "STAR BHARAT", "STAR PLUS", "ZEE TV",
    ),
    2: (
        "BIG MAGIC", "COLORS RISHTEY", "DANGAL", "SONY PAL", "STAR UTSAV", "ZEE ANMOL", "ZINDAGI(NA)",
    ),
    3: (
        "&PICTURES", "COLORS CINEPLEX", "SONY MAX(V)", "SONY MAX 2", "STAR GOLD 2", "STAR GOLD",
        "STAR GOLD SELECT SD", "UTV ACTION", "UTV MOVIES", "ZEE ACTION", "ZEE BOLLYWOOD", "ZEE CINEMA",
        "ZEE CLASSIC",
    ),
    4: (
        "ABZY MOVIES", "B4U KADAK", "B4U MOVIES", "CINEMA TV INDIA", "DABANGG", "ENTERR 10", "MAHA MOVIE",
        "RISHTEY CINEPLEX", "SONY WAH", "STAR UTSAV MOVIES", "WOW CINEMA ONE", "ZEE ANMOL CINEMA",
    ),
    5: (
        "&FLIX", "HBO(NA)", "MNX", "MOVIES NOW", "SONY PIX", "ROMEDY NOW", "STAR MOVIES ACTION(NA)",
        "STAR MOVIES", "WB(NA)", "ZEE STUDIO(NA)",
    ),
    6: (
        "ANIMAL PLANET", "DISCOVERY CHANNEL(V)", "DISCOVERY SCIENCE", "DTAMIL", "HISTORY TV 18(V)",
        "NAT GEO WILD(V)", "NATIONAL GEOGRAPHIC(V)", "SONY BBC EARTH(V)",
    ),
    7: (
        "SONY SPORTS", "STAR SPORTS CHANNELS", "OTHER SPORTS",
    ),
    8: (
        "AAKASH AATH", "COLORS BANGLA", "DD BANGLA", "RUPOSHI BANGLA", "SONY AATH", "STAR JALSHA",
        "SUN BANGLA", "ZEE BANGLA",
    ),
    9: (
        "COLORS MARATHI", "DD SAHYADRI", "SONY MARATHI", "STAR PRAVAH", "ZEE MARATHI", "ZEE YUVA",
    ),
    10: (
        "CARTOON NETWORK(V)", "DISNEY CHANNEL(V)", "DISNEY JUNIOR(V)", "DISNEY XD", "DISCOVERY KIDS",
        "HUNGAMA(V)", "MAHA CARTOON TV(NA)", "NICK JUNIOR(V)", "NICK(V)", "POGO TV(V)",
        "SONIC NICKELODEON(V)", "SONY YAY(V)", "TOONAMI(NA)",
    ),
}

# The channels that the details mart keeps.
MEMBERS = (
    "SONY TEN 4(V)", "&TV", "COLORS", "JEET PRIME(V)", "LIFE OK(NA)", "SONY SAB", "SONY ENTERTAINMENT TELEVISION",
    "STAR BHARAT", "STAR PLUS", "ZEE TV", "BIG MAGIC", "COLORS RISHTEY", "DANGAL", "SONY PAL", "STAR UTSAV",
    "ZEE ANMOL", "ZINDAGI(NA)", "&PICTURES", "COLORS CINEPLEX", "SONY MAX(V)", "SONY MAX 2", "STAR GOLD 2",
    "STAR GOLD", "STAR GOLD SELECT SD", "UTV ACTION", "UTV MOVIES", "ZEE ACTION", "ZEE BOLLYWOOD", "ZEE CINEMA",
    "ZEE CLASSIC", "ABZY MOVIES", "B4U KADAK", "B4U MOVIES", "CINEMA TV INDIA", "DABANGG", "ENTERR 10",
    "MAHA MOVIE", "RISHTEY CINEPLEX", "SONY WAH", "STAR UTSAV MOVIES", "WOW CINEMA ONE", "ZEE ANMOL CINEMA",
    "&FLIX", "HBO(NA)", "MNX", "MOVIES NOW", "SONY PIX", "ROMEDY NOW", "STAR MOVIES ACTION(NA)", "STAR MOVIES",
    "WB(NA)", "ZEE STUDIO(NA)", "ANIMAL PLANET", "DISCOVERY CHANNEL(V)", "DISCOVERY SCIENCE", "DTAMIL",
    "HISTORY TV 18(V)", "NAT GEO WILD(V)", "NATIONAL GEOGRAPHIC(V)", "SONY BBC EARTH(V)", "DD SPORTS",
    "EUROSPORT", "NEO PRIME(NA)", "NEO SPORTS(NA)", "SONY ESPN(V)", "SONY SIX(V)", "STAR SPORTS 1",
    "STAR SPORTS 1 HINDI", "STAR SPORTS 2(V)", "STAR SPORTS 3(V)", "STAR SPORTS FIRST", "STAR SPORTS SELECT 1 SD",
    "STAR SPORTS SELECT 2 SD", "SONY TEN 1", "SONY TEN 2", "SONY TEN 3", "AAKASH AATH", "COLORS BANGLA",
    "DD BANGLA", "RUPOSHI BANGLA", "SONY AATH", "STAR JALSHA", "SUN BANGLA", "ZEE BANGLA", "COLORS MARATHI",
    "DD SAHYADRI", "SONY MARATHI", "STAR PRAVAH", "ZEE MARATHI", "ZEE YUVA", "CARTOON NETWORK(V)",
    "DISNEY CHANNEL(V)", "DISNEY JUNIOR(V)", "DISNEY XD", "DISCOVERY KIDS", "HUNGAMA(V)", "MAHA CARTOON TV(NA)",
    "NICK JUNIOR(V)", "NICK(V)", "POGO TV(V)", "SONIC NICKELODEON(V)", "SONY YAY(V)", "TOONAMI(NA)",
)

# Roll-up of sports channels into one label per owner.
SPORTS_ROLL_UP = (
    ("Sony Sports", ("SONY SIX(V)", "SONY TEN 1", "SONY TEN 2", "SONY TEN 3", "SONY TEN 4(V)")),
    ("Other Sports", ("1SPORTS", "EUROSPORT")),
)


@dataclass(frozen=True)
class RollUp:
    """Members of one genre are replaced by the label of the list that names them, or by ``otherwise``."""

    genre: str
    labels: tuple[tuple[str, tuple[str, ...]], ...]
    otherwise: str


@dataclass(frozen=True)
class Rules:
    """Everything the marts need to know about names. Names are compared upper-cased unless noted."""

    universe: Mapping[str, str]  # column -> exact value, for the network share mart
    parent: str  # exact parent name that replaces the network
    network_labels: tuple[tuple[str, str], ...]
    genre_labels: tuple[tuple[str, str], ...]
    kept_labels: tuple[str, ...]
    kept_prefixes: tuple[str, ...]
    members: tuple[str, ...]
    roll_up: RollUp
    buckets: Mapping[int, tuple[str, ...]]


DEFAULT_RULES = Rules(
    universe={"targets": "Universe", "regions": "India"},
    parent="Star",
    network_labels=NETWORK_LABELS,
    genre_labels=GENRE_LABELS,
    kept_labels=REPORTED,
    kept_prefixes=REPORTED,
    members=MEMBERS,
    roll_up=RollUp("SPORTS", SPORTS_ROLL_UP, "Star Sports Channels"),
    buckets=BUCKETS,
)
