"""What is specific to a site. Jobs take a ``SiteRules`` value; nothing is read from a global."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from sitegrain.functions.nodes import Sel, el

# Path patterns, markers and scope of the page types.
PRODUCT_PATH = r"^/(?:en/)?champagnes(?:-et)?-cuvees/[^/?#]+/?$"
CATALOG_PATH = r"^/(?:en/)?(?:champagnes(?:-cuvees)?|champagnes)/?$"
WINERY_PATH = (
    r"^/(?:en/)?(?:maison(?:/|$)(?:histoire|famille|vignoble|savoirs-faire|cave)?|engagements(?:/|$))"
)
HISTORY_MARKER = "/maison/histoire"
FAMILY_MARKER = "/maison/famille"
HOME_PATHS = ("/", "/en", "/fr")
SCOPE = (
    "/en", "/en/champagnes", "/en/champagnes-et-cuvees", "/en/maison", "/en/engagements",
    "/en/champagnes-cuvees",
)
SKIPPED_LINK_PREFIXES = ("mailto:", "tel:", "#", "javascript:")

# The elements the fields are read from.
HEADING = "elementor-heading-title"
LISTING_CARD = el("div", equal={"data-elementor-type": "loop-item"})
LISTING_TITLE = el("a").inside(el("p", HEADING))
LISTING_SUMMARY = el("p").inside(el("div", "elementor-widget-text-editor"))
LINKS = el("a", has=("href",))
MENU = el("nav", equal={"aria-label": "Menu"})
MENU_LANGUAGE = "weglot-language"
MENU_LANGUAGE_LINKS = LINKS.inside(el("li", MENU_LANGUAGE).inside(MENU))
MENU_ENGLISH_LINKS = (
    el("a", equal={"title": "English"}, has=("href",)).inside(MENU),
    el("a", contain={"href": "/en/"}).inside(MENU),
)
BACKGROUND_ATTR = "data-dce-background-image-url"
BACKGROUND_STYLE = "background-image"
BACKGROUNDS = (el(has=(BACKGROUND_ATTR,)), el(contain={"style": BACKGROUND_STYLE}))
IMAGES = (el("img"), el("source").inside(el("picture")), *BACKGROUNDS)
VIDEOS = (el("video"), el("source").inside(el("video")))
MEDIA = (el("img"), *VIDEOS, el("source").inside(el("picture")), *BACKGROUNDS)
PRODUCT_ROOT = el("div", equal={"data-elementor-type": "product"})
PRODUCT_HEADINGS = el(None, HEADING).inside(PRODUCT_ROOT)
PRODUCT_DESCRIPTION = el("p").inside(el(id="section-start"))
TECH_SHEET = el(id="section-fiche-technique")
TECH_LEFT = el("p", HEADING).inside(TECH_SHEET)
TECH_RIGHT = (el("h5").inside(TECH_SHEET), el("h6").inside(TECH_SHEET))
DATA_SHEET = el("a", "elementor-button", first_of_type=True).inside(TECH_SHEET)
NOTES = el(id="section-note")
AWARDS = el("p").inside(NOTES)
TASTING = el("p").inside(el("div").after(NOTES))
STORY = el("p", HEADING).inside(el(id="passion_familiale"))
TIMELINE_TITLE = el(None, "timeline-item__card-title")
TIMELINE_TEXT = el(None, "timeline-item__card-desc")
CAROUSEL = el(None, "elementor-widget-n-carousel", having=el(None, HEADING))
FAMILY_NAME = el("h3").inside(CAROUSEL)
FAMILY_TEXT = el("div", "elementor-widget-container").inside(
    el("div", "elementor-widget-text-editor").inside(CAROUSEL)
)

# Label patterns of the technical sheet.
TEMPERATURE_KEYS = ("temperature",)
DOSAGE_KEYS = ("dosage",)
AGING_KEYS = ("aging", "ageing", "maturation", "vieillissement")
BLEND_KEYS = ("crus assembl", "crus assemb", "assembl", "blend")
VINTAGE_KEYS = ("millennium", "millésime", "vintage")


def menu_links(lang: str) -> Sel:
    """The links of one language in the language menu."""
    return LINKS.inside(el("li", MENU_LANGUAGE, f"weglot-{lang}").inside(MENU))


@dataclass(frozen=True)
class SiteRules:
    """Hosts, scope and page types of one site."""

    host: str = "www.example.com"
    domain: str = "example.com"
    entity_name: str = "Example House"
    scope: tuple[str, ...] = SCOPE
    product_path: str = PRODUCT_PATH
    catalog_path: str = CATALOG_PATH
    winery_path: str = WINERY_PATH
    history_marker: str = HISTORY_MARKER
    family_marker: str = FAMILY_MARKER
    home_paths: tuple[str, ...] = HOME_PATHS
    routed_lang: str = "fr"
    target_lang: str = "en"
    # Off by default: links with a foreign host pass the page rule, and ``/`` is no home page.
    strict_hosts: bool = False
    root_is_home: bool = False
    extra_hosts: tuple[str, ...] = field(default=())
    # Grapes are read from so many pairs of the left-hand sheet, from the first on; None reads all.
    grape_pairs: int | None = None

    @property
    def hosts(self) -> tuple[str, ...]:
        return (self.host, self.domain, *self.extra_hosts)

    @property
    def website_url(self) -> str:
        return f"https://{self.host}/"

    def with_(self, **changes) -> SiteRules:
        return replace(self, **changes)
