"""Platforms: alias domains, and what kind of page a link points to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Platform:
    """A platform whose links get their own report.

    ``video_patterns`` capture the video id, ``channel_id_pattern`` the channel
    id, each as group 1 of a match on the normalised URL.
    """

    name: str
    aliases: tuple[str, ...] = ()
    video_patterns: tuple[str, ...] = ()
    channel_pattern: str = ""
    channel_id_pattern: str = ""


# The platform's domains and link shapes.
YOUTUBE = Platform(
    name="youtube.com",
    aliases=("youtube.com", "youtu.be", "youtube-nocookie.com"),
    video_patterns=(
        r"^[^/]*youtube[^/]*/watch[?](?:.*&)?v=([A-Za-z0-9_-]{11})(?:&|\z)",
        r"^youtu[.]be/([A-Za-z0-9_-]{11})(?:[/?]|\z)",
        r"^[^/]*/(?:embed|v|shorts|live)/([A-Za-z0-9_-]{11})(?:[/?]|\z)",
    ),
    channel_pattern=r"^[^/]*/(?:channel/|c/|user/|@)",
    channel_id_pattern=r"^[^/]*/channel/(UC[A-Za-z0-9_-]{22})(?:[/?]|\z)",
)

VIDEO, CHANNEL, OTHER = "video", "channel", "other"


def fold_aliases(domain: Column, platforms: Sequence[Platform] = (YOUTUBE,)) -> Column:
    """Every alias domain of a platform under the platform's own name."""
    folded = domain
    for platform in platforms:
        folded = F.when(domain.isin(*platform.aliases), platform.name).otherwise(folded)
    return folded


def video_id(url: Column, platform: Platform = YOUTUBE) -> Column:
    """Video id in a normalised URL, or null."""
    found = [F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in platform.video_patterns]
    return F.coalesce(*found, F.lit(None).cast("string"))


def link_channel_id(url: Column, platform: Platform = YOUTUBE) -> Column:
    """Channel id in a normalised URL, or null."""
    if not platform.channel_id_pattern:
        return F.lit(None).cast("string")
    return F.nullif(F.regexp_extract(url, platform.channel_id_pattern, 1), F.lit(""))


def link_kind(url: Column, video: Column, platform: Platform = YOUTUBE) -> Column:
    """``video`` if there is a video id, else ``channel`` or ``other``."""
    kind = F.when(video.isNotNull(), VIDEO)
    if platform.channel_pattern:
        kind = kind.when(url.rlike(platform.channel_pattern), CHANNEL)
    return F.when(url.isNotNull(), kind.otherwise(OTHER))
