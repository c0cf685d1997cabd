"""Hand cases: link, normalised URL, domain, kind, video id, channel id."""

SUFFIXES = "com org net uk co.uk github.io io be co b".split()
VIDEO_ID = "abcdefghijk"
CHANNEL_ID = "UCabcdefghijklmnopqrstuv"

CASES = [
    ("", None, None, None, None, None),
    ("   ", None, None, None, None, None),
    ("//cdn.example.org/lib/", "cdn.example.org/lib", "example.org", None, None, None),
    ("HTTPS://EXAMPLE.com", "example.com", "example.com", None, None, None),
    ("a.com:8080/x", "a.com:8080/x", "a.com", None, None, None),
    ("a.com?utm_source=1&x=2", "a.com?x=2", "a.com", None, None, None),
    ("ftp://files.example.org/x", "files.example.org/x", "example.org", None, None, None),
    ("http://1.2.3.4/x", "1.2.3.4/x", None, None, None, None),
    ("http://co.uk/", "co.uk", None, None, None, None),
    ("http://localhost/x", "localhost/x", None, None, None, None),
    ("http://user:pw@example.co.uk:8080/a/index.html", "example.co.uk:8080/a", "example.co.uk", None, None, None),
    ("http://www.www.example.com", "example.com", "example.com", None, None, None),
    (
        "https://WWW.Example.COM:443/Path/?b=2&a=1&utm_source=x#frag",
        "example.com/Path?a=1&b=2",
        "example.com",
        None,
        None,
        None,
    ),
    ("https://[bad host/zz", None, None, None, None, None),
    ("https://a.b/c?d=e?f=g", "a.b/c?d=e?f=g", "a.b", None, None, None),
    ("https://example.com//", "example.com", "example.com", None, None, None),
    ("https://example.com/?", "example.com", "example.com", None, None, None),
    ("https://example.com/a\nb", "example.com/a\nb", "example.com", None, None, None),
    ("https://example.com/a&ref=1", "example.com/a&ref=1", "example.com", None, None, None),
    ("https://example.com/index.php?q=1", "example.com?q=1", "example.com", None, None, None),
    ("https://exämple.org/é?é=1", "exämple.org/é?é=1", "exämple.org", None, None, None),
    ("https://m.co.uk/p", "co.uk/p", "m.co.uk", None, None, None),
    ("https://m.co/p", "m.co/p", "m.co", None, None, None),
    (
        "https://music.youtube.com/watch?v=abcdefghijk&list=1",
        "music.youtube.com/watch?list=1&v=abcdefghijk",
        "youtube.com",
        "video",
        VIDEO_ID,
        None,
    ),
    ("https://www.", "www.", None, None, None, None),
    ("https://www.m.example.com/p", "example.com/p", "example.com", None, None, None),
    (
        "https://www.youtube-nocookie.com/embed/abcdefghijk",
        "youtube-nocookie.com/embed/abcdefghijk",
        "youtube.com",
        "video",
        VIDEO_ID,
        None,
    ),
    ("https://www.youtube.com/shorts/abcdefghijk", "youtube.com/shorts/abcdefghijk", "youtube.com", "video", VIDEO_ID, None),
    ("https://x.github.io/p/", "x.github.io/p", "x.github.io", None, None, None),
    ("https://youtu.be/abcdefghijk?t=3", "youtu.be/abcdefghijk?t=3", "youtube.com", "video", VIDEO_ID, None),
    ("https://youtube.com/", "youtube.com", "youtube.com", "other", None, None),
    ("https://youtube.com/@h", "youtube.com/@h", "youtube.com", "channel", None, None),
    ("https://youtube.com/c/Name", "youtube.com/c/Name", "youtube.com", "channel", None, None),
    (
        "https://youtube.com/channel/UCabcdefghijklmnopqrstuv/videos",
        "youtube.com/channel/UCabcdefghijklmnopqrstuv/videos",
        "youtube.com",
        "channel",
        None,
        CHANNEL_ID,
    ),
    ("https://youtube.com/embed/abcdefghijk", "youtube.com/embed/abcdefghijk", "youtube.com", "video", VIDEO_ID, None),
    ("https://youtube.com/live/abcdefghijk", "youtube.com/live/abcdefghijk", "youtube.com", "video", VIDEO_ID, None),
    ("https://youtube.com/playlist?list=PL1", "youtube.com/playlist?list=PL1", "youtube.com", "other", None, None),
    ("https://youtube.com/user/Nm", "youtube.com/user/Nm", "youtube.com", "channel", None, None),
    ("https://youtube.com/v/abcdefghijk", "youtube.com/v/abcdefghijk", "youtube.com", "video", VIDEO_ID, None),
    (
        "https://youtube.com/watch?list=1&v=abcdefghijk",
        "youtube.com/watch?list=1&v=abcdefghijk",
        "youtube.com",
        "video",
        VIDEO_ID,
        None,
    ),
    ("https://youtube.com/watch?v=short", "youtube.com/watch?v=short", "youtube.com", "other", None, None),
    ("javascript:void(0)", None, None, None, None, None),
    ("mailto:a@b.com", None, None, None, None, None),
    ("x", "x", None, None, None, None),
]
