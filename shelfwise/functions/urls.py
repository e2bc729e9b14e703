"""Address expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import col

# Path shapes of category and product pages in the headphone shop.
CATEGORY_FOLDER = "/thiet-bi-am-thanh/tai-nghe/"
SHORT_CATEGORY_PREFIX = "tai-nghe/"
SHORT_CATEGORY_BELOW = 25
PRODUCT_SLUGS = ["tai-nghe-chup-tai", "tai-nghe-bluetooth", "tai-nghe-gaming"]
PRODUCT_PREFIX = "tai-nghe-"
PRODUCT_LONGER_THAN = 25


def is_product_url(url: Column | str, host: str) -> Column:
    """True for a product page of the shop, False for category pages and other hosts."""
    address = col(url)
    path = F.trim(F.element_at(F.split(address, host.replace(".", r"\.")), -1), F.lit("/"))
    slashes = F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
    category = (path.contains(CATEGORY_FOLDER) & (slashes >= 2)) | (
        path.startswith(SHORT_CATEGORY_PREFIX) & (F.length(path) < SHORT_CATEGORY_BELOW)
    )
    slug = F.lit(False)
    for word in PRODUCT_SLUGS:
        slug = slug | path.contains(word)
    long_page = (
        path.startswith(PRODUCT_PREFIX) & path.endswith(".html") & (F.length(path) > PRODUCT_LONGER_THAN)
    )
    on_site = address.contains(host) & address.contains(".html")
    return F.coalesce(on_site & ~category & (slug | long_page), F.lit(False))


def slug(url: Column | str) -> Column:
    """Last path part without ``.html``."""
    return F.replace(F.element_at(F.split(col(url), "/"), -1), F.lit(".html"), F.lit(""))


def absolute_url(base: str, href: Column | str) -> Column:
    """href resolved against the root of a site (``base`` has no path)."""
    link = col(href)
    root = base.rstrip("/")
    scheme = root.split("://")[0]
    bare = F.regexp_replace(link, r"^(\.{1,2}/)+", "")
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(F.lit(scheme + ":"), link))
        .when(link.startswith("/"), F.concat(F.lit(root), link))
        .when(link.rlike(r"^([?#]|$)"), F.concat(F.lit(root), link))
        .otherwise(F.concat(F.lit(root + "/"), bare))
    )


def page_url(url: Column | str, page: int) -> Column:
    """The address of one page of a listing: sets ``page`` and drops parameters without a value."""
    address = col(url)
    if page == 1:
        return address
    mark = F.instr(address, "#")
    fragment = F.when(mark > 0, F.substring(address, mark, F.length(address))).otherwise(F.lit(""))
    body = F.when(mark > 0, F.left(address, mark - 1)).otherwise(address)
    path = F.split_part(body, F.lit("?"), F.lit(1))
    query = F.substring(body, F.length(path) + 2, F.length(body))
    pairs = F.filter(F.split(query, "&"), lambda x: x.rlike("^[^=]+=.+"))
    renamed = F.transform(
        pairs, lambda x: F.when(x.startswith("page="), F.lit(f"page={page}")).otherwise(x)
    )
    first = F.array_position(renamed, f"page={page}")
    single = F.filter(renamed, lambda x, i: (x != f"page={page}") | (i + 1 == first))
    full = F.when(first > 0, single).otherwise(F.array_append(single, F.lit(f"page={page}")))
    return F.concat(path, F.lit("?"), F.array_join(full, "&"), fragment)


def appended_page_url(url: Column | str, page: int) -> Column:
    """The plainer rule of another shop: append ``page`` with ``?`` or ``&``."""
    address = col(url)
    if page == 1:
        return address
    return F.concat(
        address, F.when(address.contains("?"), F.lit("&")).otherwise(F.lit("?")), F.lit(f"page={page}")
    )


def search_url(base: str, path: str, query: Column | str) -> Column:
    """Search address with a percent-encoded query (blank as ``%20``)."""
    encoded = F.replace(F.url_encode(col(query)), F.lit("+"), F.lit("%20"))
    return F.concat(F.lit(f"{base.rstrip('/')}{path}?q="), encoded)
