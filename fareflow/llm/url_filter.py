"""URL filter: site rules first, then logistic regression on hashed character n-grams.

Everything is DataFrame expressions. The model is trained by gradient descent on a small labelled
table, which is one row for each URL; its weights are one bounded array.

Defined results: a URL that is null or holds no "://" has an empty host and path, fits no rule, and is
judged by the model's bias alone. Repeated rows get a verdict each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fareflow.llm.common import pick

BUCKETS = 4096
GRAM_SIZES = (3, 4)
STEPS = 15
RATE = 0.3
BIAS = -1
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Verdict, host and start of the path.
Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_index(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The place in ``rules`` of the longest rule that fits; null where none does."""
    fits = []
    for place in sorted(range(len(rules)), key=lambda i: (-len(rules[i][1] + rules[i][2]), i)):
        _, site, start = rules[place]
        on_site = (host == site) | host.endswith(f".{site}")
        fits.append(F.when(on_site & path.startswith(start), F.lit(place)))
    return F.coalesce(*fits) if fits else F.lit(None).cast("int")


def grams(host: Column, path: Column) -> Column:
    """The buckets of all character n-grams; a mark separates host and path."""
    marked = F.concat(F.lit("^"), host, F.lit("$"), path)
    parts = [F.regexp_extract_all(marked, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in GRAM_SIZES]
    return F.when((host != "") | (path != ""), F.transform(
        F.concat(*parts), lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int"))).otherwise(
        F.array().cast("array<int>"))


def probability(buckets: Column, weights: list[float], bias: float) -> Column:
    """The weights travel as one folded array literal of BUCKETS numbers."""
    array = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    total = F.aggregate(buckets, F.lit(0.0), lambda s, b: s + F.element_at(array, b + 1))
    margin = F.lit(bias) + total / F.sqrt(F.greatest(F.size(buckets), F.lit(1)))
    return 1 / (1 + F.exp(-margin))


def train(labelled: DataFrame) -> tuple[list[float], float]:
    """Weights and bias from ``labelled`` (url, bad: 0 or 1), a small table of at most some thousand rows.

    Every step is one aggregate in one task, which sends back at most one slope for each bucket.
    """
    rows = labelled.select(
        grams(host_of(F.col("url")), path_of(F.col("url"))).alias("buckets"),
        F.col("bad").cast("double").alias("bad")).coalesce(1)
    size = 1 / F.sqrt(F.greatest(F.size("buckets"), F.lit(1)))
    weights, bias, squares = [0.0] * BUCKETS, 0.0, [1e-6] * (BUCKETS + 1)
    for _ in range(STEPS):
        off = probability(F.col("buckets"), weights, bias) - F.col("bad")
        slopes = dict(rows.select(off.alias("off"), size.alias("size"), F.explode(
            F.concat("buckets", F.array(F.lit(BIAS)))).alias("at")).groupBy("at").agg(
            F.sum(F.col("off") * F.when(F.col("at") == BIAS, 1.0).otherwise(F.col("size")))).collect())
        for at, slope in slopes.items():  # each weight has a step size of its own
            squares[at] += slope * slope
            if at == BIAS:
                bias -= RATE * slope / squares[at] ** 0.5
            else:
                weights[at] -= RATE * slope / squares[at] ** 0.5
    return weights, bias


#: The labelled table, written for this model: 1 stands for kinds of sites that web corpora leave out (shops for pills and
#: copies, betting, adult sites, cracked software, loans, phishing, link farms), 0 for others.
LABELLED = """
0 https://www.citynewsdaily.com/local/2021/05/council-approves-new-park
0 https://en.openencyclopedia.org/wiki/Photosynthesis
0 https://docs.pythonguide.io/tutorial/classes.html
0 https://blog.gardenersworldly.co.uk/how-to-prune-roses
0 http://www.riverdaleschool.edu/calendar/term-dates
0 https://www.weatherwatch.net/forecast/berlin
0 https://recipes.homecookery.com/soups/lentil-soup
0 https://journal.marinebiology.org/article/10/3/221
0 https://www.statelibrary.gov/collections/maps
0 https://forum.woodworkers.net/t/choosing-a-plane/4512
0 https://www.museumofhistory.org/exhibitions/bronze-age
0 https://shop.bookcorner.co.uk/fiction/classics
0 https://www.hikingtrails.ch/routes/lake-loop
0 https://support.cameraworks.com/manuals/model-20
0 https://www.healthadvice.gov/topics/vaccination
0 https://sports.dailyherald.com/football/results
0 https://www.astronomyclub.org/events/meteor-shower
0 https://news.parliamentwatch.eu/debates/2020/climate
0 https://www.orchestra-hall.de/programm/mai
0 https://wiki.linuxusers.org/index.php/Filesystems
0 https://www.countyfair.us/exhibitors/schedule
0 https://developer.mapservices.com/api/reference
0 https://www.birdwatchers.ca/species/kingfisher
0 https://travel.islandferries.gr/timetable
0 https://www.languageschool.fr/cours/debutants
0 https://archive.townrecords.org/births/1890
0 https://www.carpentryschool.com/courses/joints
0 https://physics.university.edu/people/faculty
0 https://www.theatreweekly.com/reviews/hamlet
0 https://www.chesshistory.net/games/openings
0 https://en.wikitravelers.org/Lisbon
0 https://www.parentsforum.co.uk/toddlers/sleep
0 https://www.beekeepers.org.uk/advice/swarming
0 https://data.nationalstatistics.gov/population/2019
0 https://www.architecturetoday.com/projects/timber-house
0 https://photos.landscapegallery.net/mountains/dolomites
0 https://www.trainspotters.org/stations/york
0 https://blog.smallfarm.com/chickens/coop-plans
0 https://www.legalaid.org/housing/tenants-rights
0 https://www.poetryreview.org/poems/autumn
0 https://learn.mathpractice.com/algebra/quadratics
0 https://www.dailyexpressnews.in/business/markets
0 https://www.oceanresearch.org/expeditions/2018
0 https://www.vintagebicycles.nl/restoration
0 https://www.cyclingclub.be/calendar
0 https://www.volunteerfire.org/training
0 https://www.geologysociety.org/journal/volume12
0 https://help.texteditor.dev/shortcuts
0 https://www.villagebakery.com/menu
0 https://www.dentalclinic-park.de/kontakt
0 https://www.insurancefacts.gov/guides/home
0 https://www.economicsreview.org/papers/inflation
0 https://www.sailingschool.hr/kurse
0 https://kids.sciencefun.org/experiments/volcano
0 https://www.translationbureau.ca/services
0 https://thread.knittersforum.com/patterns/socks
0 https://www.musictheory.org/lessons/intervals
0 https://www.harborauthority.no/ships/arrivals
0 https://www.thunderbay-tourism.ca/things-to-do
0 https://www.motherearthgardens.com/compost
0 https://www.regionalairport.com/departures
0 https://www.conditionmonitoring.org/standards
0 https://www.traditioncrafts.ie/weaving
0 https://render.graphicsjournal.org/shaders
0 https://www.otherworldbooks.com/authors
0 https://www.attentionresearch.org/studies
0 https://www.stationhouse-inn.com/rooms
0 https://www.nationalpark.is/trails/glacier
0 https://www.essexcounty.gov/roads
0 https://www.analyticsweekly.com/python
0 https://www.sussextrains.co.uk/fares
0 https://example.com/
0 https://example.org/index.html
0 https://www.example.net/a/2021/05?page=2
0 https://m.test.org/en/12
0 http://blog.example.com/en/3
1 http://cheap-pills-online.biz/buy/viagra-no-prescription
1 http://www.casino-bonus-777.com/free-spins
1 http://free-warez-download.ru/cracks/photoshop-keygen.exe
1 http://hot-singles-tonight.xxx/join-now
1 https://payday-loans-fast.info/apply?aff=3321
1 http://replica-watches-sale.cn/rolex
1 http://torrent-crack-serial.net/full-version
1 http://www.porn-tube-videos.com/latest
1 https://poker-chips-win.bet/jackpot
1 http://buy-followers-cheap.top/instagram
1 http://seo-backlinks-farm.xyz/packages
1 http://lottery-winner-claim.club/prize
1 https://crypto-giveaway-x2.live/send
1 http://keygen-serials.ws/windows-activator
1 http://best-slots-online.casino/bonus
1 http://adult-webcams-live.sex/girls
1 http://online-pharmacy-rx.su/tramadol
1 http://work-from-home-cash.biz/make-money-fast
1 http://miracle-diet-pills.shop/lose-weight
1 http://bet365-bonus-code.win/sports-betting
1 http://sexy-dating-chat.date/signup
1 http://xxx-movies-free.to/download
1 http://cialis-levitra-discount.pw/order
1 http://secure-bank-login-verify.tk/account/update
1 http://paypal-account-verify.ml/signin
1 http://cheap-replica-handbags.store/gucci
1 http://roulette-blackjack-vip.casino/play-now
1 http://penis-enlargement-pills.biz/results
1 http://nude-celebs-leaked.xxx/pics
1 http://instant-cash-loan.loan/bad-credit-ok
1 http://get-rich-quick.click/forex-signals
1 http://hacked-games-apk.download/mod-unlimited
1 http://link-exchange-directory.win/add-url
1 http://spam-blast-mailer.info/bulk-email
1 http://free-iphone-winner.gq/claim-prize
1 http://escort-girls-city.sex/booking
1 http://steroids-for-sale.ru/buy-online
1 http://fake-diploma-buy.com/university-degree
1 http://essay-writing-cheap.biz/buy-essay
1 http://online-gambling-slots.bet/free-bonus
1 http://viagra-cheap-online.top/discount
1 http://xxx-cams.tv/live-sex
1 http://porn-pics-hd.net/gallery
1 http://casino-jackpot-city.win/spins
1 http://payday-cash-advance.loan/instant
1 http://warez-crack-keygen.download/serial
1 http://win-free-gift-cards.click/survey
1 http://double-your-bitcoin.cash/invest
1 http://cheap-cigarettes-mail.biz/order
1 http://sexshop-toys-xxx.shop/sale
1 http://mail-order-brides.date/russian
1 http://teen-webcam-sex.cam/now
1 http://betting-tips-sure-win.info/fixed-matches
1 http://adult-friend-hookup.club/join
1 http://oxycontin-no-rx.pw/pharmacy
1 http://pirated-movies-hd.to/stream-free
1 http://buy-cheap-xanax.su/pills
1 http://slot-machine-bonus.casino/deposit
1 http://clickbank-cash-system.biz/earn-money
1 http://milf-tube.xxx/videos
1 http://cracked-software.ws/activator
1 http://bulk-seo-links.top/buy-backlinks
1 http://fat-burner-pills.shop/order-now
1 http://forex-robot-profit.click/signals
1 http://poker-bonus-codes.bet/no-deposit
1 http://hot-girls-nude.cam/watch
1 http://free-v-bucks-generator.gq/verify
1 http://gift-card-generator.ml/no-survey
1 http://credit-repair-instant.loan/apply
1 http://ransom-unlock-virus.tk/call-now
1 http://cheap-meds-canada.pw/buy
1 http://casino-no-deposit.win/bonus-code
1 http://replica-sneakers-outlet.store/cheap
1 http://sex-dating-site.date/meet
1 http://make-cash-online.cash/work-home
1 http://torrent-movies-free.download/hd
"""


def labelled_urls(spark: SparkSession) -> DataFrame:
    """url and bad (0 or 1) of the labelled table."""
    rows = ", ".join(f"('{url}', {label})" for label, url in map(str.split, LABELLED.split("\n")[1:-1]))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS urls(url, bad)")


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], weights: list[float], bias: float,
    id_column: str = "page_id", url_column: str = "url", threshold: float = 0.6,
) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's probability of a bad URL, for every row."""
    rows = pick(pages, id_column, url_column).toDF("page_id", "url").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("fits", rule_index(rules, F.col("host"), F.col("path")))
    named = F.lit(None).cast("string")
    ruled = F.lit(None).cast("string")
    for place, (verdict, site, start) in enumerate(rules):
        named = F.when(F.col("fits") == place, site + start).otherwise(named)
        ruled = F.when(F.col("fits") == place, verdict).otherwise(ruled)
    score = probability(grams(F.col("host"), F.col("path")), weights, bias)
    scored = rows.select("page_id", "host", "path", named.alias("rule"), ruled.alias("ruled"), score.alias("p_bad"))
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("p_bad") >= threshold, "block").otherwise("allow")).alias("verdict"), "p_bad")
