"""Terms of the url filter, by kind, with their inflections.

General words of each trade, not names of sites in any table. ``STRICT``
terms hardly stand in a harmless url; ``SOFT`` ones do, so a url needs several.
Forms of one word (``loan``, ``loans``) are one entry of the vocabulary.
"""

from __future__ import annotations

import re

STRICT: dict[str, str] = {
    "adult": """
        porn porno pornos porns pornography pornographic pornhub pornstar pornstars pornvideo pornvideos freeporn gayporn teenporn
        xxx xxxvideo xxxvideos hentai hentais camgirl camgirls camsex sexcam sexcams livesex sexchat sexchats sextape sextapes
        sexvideo sexvideos sexshop sexshops sexdating escort escorts escortservice callgirl callgirls blowjob blowjobs handjob
        handjobs cumshot cumshots creampie creampies gangbang gangbangs deepthroat bukkake milf milfs upskirt upskirts
        xvideos xhamster redtube youporn chaturbate brazzers onlyfansleak onlyfansleaks nsfwgifs rule34 fleshlight
        masturbate masturbates masturbating masturbation fuck fucks fucked fucking fuckbook pussy pussies bdsm fetishes
    """,
    "gambling": """
        onlinecasino onlinecasinos casinobonus casinobonuses casinoonline casinogames sportsbetting sportbetting sportsbook
        sportsbooks freespins freebet freebets slotmachine slotmachines onlineslots slotsonline onlinepoker pokeronline
        videopoker bettingtips bookmakers sportwetten spielbank togel judionline situsjudi slotgacor sbobet baccaratonline
    """,
    "drugs": """
        buyviagra buycialis genericviagra genericcialis cheapviagra cheapcialis onlinepharmacy buyxanax buytramadol
        buyadderall buysteroids buyoxycodone cannabisshop weedshop darknetmarket penisenlargement
    """,
    "piracy": """
        warez keygen keygens cracked crackz serialz serialkeys nulled torrents torrentz thepiratebay piratebay kickasstorrents
        fullcrack cracksoftware crackedsoftware
    """,
    "fraud": """
        phishing phish phished phisher phishers malware malwares ransomware spyware trojans botnet botnets scamware
        carding cvvshop fullz fakeid fakeids moneymule getrichquick paydayloan paydayloans quickloan quickloans
        doublebitcoin freebitcoin freegiftcard freegiftcards freevbucks freerobux spambot spambots spammer spammers linkfarm
        linkfarms contentfarm contentfarms buybacklinks buyfollowers buylikes
    """,
    "tracking": """
        adserver adservers adserving adtrack adtracker adtracking adclick adclicks clicktracker clicktracking clickbank
        trackingpixel trackingpixels popunder popunders doubleclick adsystem adservice adservices adnetwork adnetworks
        adware adwares malvertising cryptojacking coinhive
    """,
}

SOFT: dict[str, str] = {
    "adult": """
        adult adults dating nude nudes nudity naked sex sexy sexual erotic erotica erotik fetish kinky horny webcam
        webcams stripper strippers striptease lingerie hookup hookups swinger swingers playboy topless busty lesbian
        lesbians amateur amateurs nsfw stepmom orgy orgies orgasm orgasms boobs tits anal
    """,
    "gambling": """
        casino casinos poker bet bets betting bettor bettors wager wagers wagering wagered gamble gambles gambling gambler
        gamblers jackpot jackpots lottery lotteries lotto roulette blackjack baccarat bingo slot slots craps bookie bookies
        bookmaker odds win wins winner winners winning winnings bonus bonuses spin spins payout payouts raffle raffles
        sweepstake sweepstakes keno dice
    """,
    "drugs": """
        viagra cialis levitra sildenafil tadalafil xanax valium ambien tramadol adderall oxycodone oxycontin vicodin
        hydrocodone percocet phentermine modafinil steroid steroids pill pills pharma pharmacy pharmacies drug drugs drugstore
        drugstores meds medication medications prescription prescriptions weed cannabis marijuana cbd thc kratom cocaine
        heroin ecstasy lsd opioid opioids botox enlargement potency impotence erectile
    """,
    "piracy": """
        crack cracks cracking serial serials torrent pirate pirated pirates piracy nocd activator activators
        unlocker fulldownload leaked leaks rapidshare
    """,
    "fraud": """
        loan loans payday lend lender lenders lending credit credits debt debts mortgage mortgages refinance insurance cash
        money rich millionaire profit profits earn earns earning earnings income forex crypto bitcoin investment investments
        scam scams scammer fraud fake replica replicas counterfeit rolex hack hacks hacked hacker spam spams spammed spamming spammy
        prize prizes reward rewards giveaway giveaways gift gifts giftcard giftcards voucher vouchers coupon coupons
        inheritance guaranteed miracle
    """,
    "selling": """
        free cheap cheaper cheapest discount discounts discounted bargain bargains deal deals buy buying sale sales
        wholesale clearance offer offers promo promos promotion promotions slimming weightloss diet diets
    """,
    "tracking": """
        ad ads advert adverts advertise advertiser advertisers advertising advertisement advertisements banner banners popup
        popups click clicks clicked track tracks tracker trackers tracking tracked pixel pixels beacon beacons affiliate
        affiliates affid referral referrals sponsor sponsored sponsors telemetry fingerprinting retargeting
    """,
}


# Forms of one word that no ending of ``entry`` relates.
SAME_WORD = (
    ("ad", "ads", "advert", "adverts", "advertise", "advertiser", "advertisers", "advertising", "advertisement", "advertisements"),
    ("adult", "adults"),
    ("crypto", "cryptos", "cryptocurrency"),
    ("erotic", "erotica", "erotik"),
    ("lotto", "lottery", "lotteries"),
    ("meds", "medication", "medications"),
    ("nude", "nudes", "nudity"),
    ("pharma", "pharmacy", "pharmacies"),
    ("pirate", "pirated", "pirates", "piracy"),
    ("promo", "promos", "promotion", "promotions"),
    ("sex", "sexy", "sexual"),
    ("spam", "spams", "spammed", "spamming", "spammy"),
    ("giveaway", "giveaways"),
)
_SAME = {form: forms[0] for forms in SAME_WORD for form in forms}


def entry(term: str) -> str:
    """The entry that a term is a form of: plural and verbal endings, a final
    e and the doubled consonant before an ending don't tell terms apart."""
    if term in _SAME:
        return _SAME[term]
    if len(term) > 4 and term.endswith("ies"):
        word = term[:-3] + "y"
    elif len(term) > 4 and re.search("(?:[sxz]|ch|sh)es$", term):
        word = term[:-2]
    elif len(term) > 3 and re.search("[^sui]s$", term):
        word = term[:-1]
    else:
        word = term
    if word in _SAME:
        return _SAME[word]
    while len(stem := re.sub("(?:ing|ed|est|er|or)$", "", word)) >= 3 and stem != word:
        word = re.sub("([bdgklmnprt])\\1$", "\\1", stem)
    return word.removesuffix("e")


def terms(table: dict[str, str]) -> tuple[str, ...]:
    """All terms, each once, in order."""
    return tuple(dict.fromkeys(t for words in table.values() for t in words.split()))
